"""CLI: run registered queries against their DuckDB oracle.
usage: python tests/check_oracle.py [sf_dir] [key-substring ...]"""
import json, sys, time, traceback
sys.path.insert(0, "/root/repo"); sys.path.insert(0, "/root/repo/tests")
from oracle import duck, compare
from tessera.session import local_session, ensure_checkpoint_dir
import __spark_entry__ as se

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
pats = sys.argv[2:]
spark = local_session()
ensure_checkpoint_dir(spark)
qs, sql = se.queries(), se.oracle_sql()
con = duck(sf)
bad = 0
for k, fn in qs.items():
    if pats and not any(p in k for p in pats):
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if k in sql:
            r = compare(df, con, sql[k])
            status = "OK " if r["ok"] else "BAD"
            if not r["ok"]:
                bad += 1
        else:
            n = df.count(); r = {"rows": n}; status = "ROW"
    except Exception as e:  # noqa: BLE001
        bad += 1; status = "ERR"; r = {"err": str(e).split("\n")[0][:400]}
    print(f"{status} {k:32s} {time.time()-t:6.2f}s " + ("" if status == "OK " else json.dumps(r, default=str)[:900]), flush=True)
print("bad:", bad)
