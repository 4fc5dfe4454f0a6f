"""Triple-pattern queries as DataFrame joins on a triple table
``(s, p, o, o_kind, lang)``.

A pattern is three terms; a term starting with ``?`` is a variable, anything
else a constant.  A pattern becomes a filtered projection of the triple table
whose columns are its variables; patterns sharing variables are joined on
them.  There is no query-text parser: queries are built in Python.

Solution mappings with unbound variables are rows with NULLs, and the
SPARQL join of such mappings (``compatible_join``) is an equi-join on the
variables bound on both sides plus a residual that lets NULL match anything."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.fixpoint import CHECKPOINT_EVERY, cut, fixpoint, reach


def is_var(term) -> bool:
    return isinstance(term, str) and term.startswith("?")


class Triples:
    """A triple set read by predicate.

    ``source`` is a triple frame, or a function that gives the triples of some
    predicates (all for None), so that a pattern reads only what holds its
    predicate.  ``stats`` (see ``measured``) let ``bgp`` order its joins."""

    def __init__(self, source: DataFrame | Callable[[set[str] | None], DataFrame], stats: dict[str, tuple[int, int, int]] | None = None):
        self.source = source if callable(source) else _filtered(source)
        self.stats = stats

    @property
    def df(self) -> DataFrame:
        return self.source(None)

    @classmethod
    def materialized(cls, df: DataFrame, path: str) -> "Triples":
        """Write the triple set partitioned by predicate and read it back:
        every pattern with a constant predicate then scans only that
        predicate's folder (partition pruning), and the triples are derived
        once.  Worth it for triples that are read many times (``opened``)."""
        df.write.mode("overwrite").partitionBy("p").parquet(path)
        return cls(df.sparkSession.read.schema(df.schema).parquet(path))  # no partition type inference

    @classmethod
    def opened(cls, source: Callable[[set[str] | None], DataFrame], patterns: list[tuple], path: str) -> "Triples":
        """Triples for these patterns.  Predicates that at least ``STORED_READS`` of
        them read are derived once, stored and measured (all, if a pattern with a
        variable predicate reads them all anyway); the others are filtered where they
        lie.  Nothing is written for one or two patterns."""
        reads = Counter(p for _, p, _ in patterns)
        every = sum(n for p, n in reads.items() if is_var(p))  # a variable predicate reads them all
        often = {p for p, n in reads.items() if not is_var(p) and n + every >= STORED_READS}
        if not often:
            return cls(source)
        if every:
            return cls.materialized(source(None), path).measured()
        held = cls.materialized(source(often), path).measured()

        def both(wanted: set[str] | None) -> DataFrame:
            return held.source(wanted) if wanted is not None and wanted <= often else source(wanted)

        return cls(both, held.stats)

    def measured(self, predicates: set[str] | None = None) -> "Triples":
        """With rows, distinct subjects and distinct objects of each predicate (one
        aggregation; a row for each predicate comes back)."""
        rows = self.source(predicates).groupBy("p").agg(
            F.count(F.lit(1)).alias("n"), F.approx_count_distinct("s").alias("s"), F.approx_count_distinct("o").alias("o")).collect()
        return Triples(self.source, {r.p: (r.n, max(1, min(r.n, r.s)), max(1, min(r.n, r.o))) for r in rows})

    def pattern(self, s, p, o, *, lang: str | None = None, kind: str | None = None) -> DataFrame:
        """Bindings of one triple pattern.  ``lang``/``kind`` name extra
        columns carrying the language tag / term kind of the object."""
        df = self.source(None if is_var(p) else {p})
        bound: dict[str, str] = {}
        for pos, term in (("s", s), ("p", p), ("o", o)):
            if is_var(term):
                name = term[1:]
                if name in bound:
                    df = df.filter(F.col(pos) == F.col(bound[name]))
                else:
                    bound[name] = pos
            else:
                df = df.filter(F.col(pos) == F.lit(term))
        cols = [F.col(pos).alias(name) for name, pos in bound.items()]
        if lang:
            cols.append(F.col("lang").alias(lang))
        if kind:
            cols.append(F.col("o_kind").alias(kind))
        return df.select(*cols)

    def estimate(self, pattern: tuple) -> tuple[float, dict[str, float]] | None:
        """(rows, distinct values of each variable) of a pattern by the statistics;
        None without any for its predicate."""
        s, p, o = pattern
        if not self.stats or not is_var(p) and p not in self.stats:
            return None
        n, subjects, objects = self.stats[p] if not is_var(p) else (
            sum(x[0] for x in self.stats.values()), max(x[1] for x in self.stats.values()), max(x[2] for x in self.stats.values()))
        rows = n / (1 if is_var(s) else subjects) / (1 if is_var(o) else objects)
        distinct = {t[1:]: min(rows, d) for t, d in ((s, subjects), (o, objects)) if is_var(t)}
        return rows, distinct | ({p[1:]: float(len(self.stats))} if is_var(p) else {})

    def bgp(self, *patterns: tuple) -> DataFrame:
        """Basic graph pattern: patterns joined on shared variables, in the order
        that ``join_order`` gives."""
        frames = [self.pattern(*pt) if isinstance(pt, tuple) else pt for pt in patterns]
        return join_all([frames[i] for i in self.join_order(patterns)])

    def join_order(self, patterns) -> list[int]:
        """The pattern of fewest rows first, then always the one that keeps the
        joined rows fewest: |A| * |B| / the larger number of distinct values of the
        shared variables.  Patterns with more constants go first where the
        statistics say nothing."""
        known = [self.estimate(pt) if isinstance(pt, tuple) else None for pt in patterns]
        if any(k is None for k in known):
            return sorted(range(len(patterns)), key=lambda i: -_constants(patterns[i]))
        left = sorted(range(len(patterns)), key=lambda i: known[i][0])
        order = [left.pop(0)]
        rows, distinct = known[order[0]][0], dict(known[order[0]][1])
        while left:
            def joined(i: int) -> float:
                shared = known[i][1].keys() & distinct.keys()
                size = rows * known[i][0]
                for v in shared:
                    size /= max(distinct[v], known[i][1][v], 1.0)
                return size if shared else float("inf")

            best = min(left, key=joined)
            rows = min(joined(best), rows * known[best][0])
            left.remove(best)
            order.append(best)
            for v, d in known[best][1].items():
                distinct[v] = min(d, distinct.get(v, d), max(rows, 1.0))
        return order


#: Reads of a predicate from which storing it pays.
STORED_READS = 3


def _filtered(df: DataFrame) -> Callable[[set[str] | None], DataFrame]:
    return lambda wanted: df if wanted is None else df.filter(F.col("p").isin(sorted(wanted)))


def _constants(pt) -> int:
    return sum(0 if is_var(t) else 1 for t in pt) if isinstance(pt, tuple) else 0


def join_all(frames: list[DataFrame]) -> DataFrame:
    """Inner joins on shared columns; a frame sharing nothing with what is
    already joined is deferred until it does (never a cartesian product)."""
    acc = frames[0]
    pending = list(frames[1:])
    while pending:
        for i, f in enumerate(pending):
            shared = [c for c in f.columns if c in acc.columns]
            if shared:
                acc = acc.join(f, on=shared, how="inner")
                pending.pop(i)
                break
        else:
            raise ValueError("pattern shares no variable with the rest (would be a cartesian product)")
    return acc


def _compatible(left: DataFrame, right: DataFrame, always_bound: list[str] | None) -> tuple[DataFrame, Column, list[str]]:
    """(right with prefixed columns, join condition, shared variables).  Shared
    variables outside ``always_bound`` (default: none is) agree when one side
    leaves them unbound; the others are the equi-join key."""
    shared = [c for c in right.columns if c in left.columns]
    keys = shared if always_bound is None else [c for c in shared if c in always_bound]
    if not keys:
        raise ValueError("no variable is bound on both sides (would compare all pairs)")
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") for c in right.columns])
    cond = F.lit(True)
    for c in shared:
        x, y = left[c], renamed[f"_r_{c}"]
        cond = cond & ((x == y) if c in keys else (x == y) | x.isNull() | y.isNull())
    return renamed, cond, shared


def optional(left: DataFrame, right: DataFrame, always_bound: list[str] | None = None) -> DataFrame:
    """``OPTIONAL {right}``: left outer join on the shared variables; name
    those that every row binds in ``always_bound`` when others may be unbound
    (an unbound variable is then compatible with, and takes, any value)."""
    renamed, cond, shared = _compatible(left, right, always_bound)
    new = [c for c in right.columns if c not in shared]
    return left.join(renamed, cond, "left").select(
        *[F.coalesce(left[c], F.col(f"_r_{c}")).alias(c) if c in shared else left[c] for c in left.columns],
        *[F.col(f"_r_{c}").alias(c) for c in new])


def union(*branches: DataFrame) -> DataFrame:
    """``{A} UNION {B}``: bag union; variables missing in a branch are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)


def not_exists(left: DataFrame, inner: DataFrame, always_bound: list[str] | None = None) -> DataFrame:
    """``FILTER NOT EXISTS {inner}`` correlated on the shared variables (see ``optional``)."""
    renamed, cond, _ = _compatible(left, inner, always_bound)
    return left.join(renamed, cond, "left_anti")


def compatible_join(a: DataFrame, b: DataFrame, always_bound: list[str]) -> DataFrame:
    """Join of solution sequences whose shared variables may be unbound.

    ``always_bound`` variables are bound in every row of both sides and form
    the equi-join key (so the join stays a hash/sort-merge join); the other
    shared variables must be equal when bound on both sides, and the output
    keeps whichever side bound them."""
    shared = [c for c in a.columns if c in b.columns]
    maybe = [c for c in shared if c not in always_bound]
    aa = a.select(*[F.col(c).alias(f"_a_{c}") if c in maybe else F.col(c) for c in a.columns])
    bb = b.select(*[F.col(c).alias(f"_b_{c}") if c in maybe else F.col(c) for c in b.columns])
    cond: Column | None = None
    for c in maybe:
        x, y = F.col(f"_a_{c}"), F.col(f"_b_{c}")
        term = (x == y) | x.isNull() | y.isNull()
        cond = term if cond is None else cond & term
    j = aa.join(bb, on=always_bound, how="inner")
    if cond is not None:
        j = j.filter(cond)
    rest = [c for c in j.columns if not c.startswith("_a_") and not c.startswith("_b_")]
    return j.select(*rest, *[F.coalesce(F.col(f"_a_{c}"), F.col(f"_b_{c}")).alias(c) for c in maybe])


def path_star_then(triples: DataFrame, starts: DataFrame, step_pred: str, last_pred: str,
                   start_col: str = "start", out_col: str = "member") -> DataFrame:
    """Property path ``step_pred* / last_pred`` from each start node: zero or
    more ``step_pred`` edges (duplicate-free nodes, start included), then one
    ``last_pred`` edge.  ``starts`` has one column ``start_col``."""
    steps = triples.filter(F.col("p") == step_pred).select(F.col("s").alias("node"), F.col("o").alias("next"))
    reached = reach(starts.select(F.col(start_col).alias("start"), F.col(start_col).alias("node")), steps)
    last = triples.filter(F.col("p") == last_pred).select(F.col("s").alias("node"), F.col("o").alias(out_col))
    return reached.join(last, "node").select(F.col("start").alias(start_col), out_col).distinct()


def subclass_closure(triples: DataFrame, roots: DataFrame, pred: str = "subClassOf") -> DataFrame:
    """(root, cls): every class at or below each root along ``pred`` edges."""
    sub = cut(triples.filter(F.col("p") == pred).select(F.col("s").alias("child"), F.col("o").alias("cls")))
    seed = roots.select(F.col("root"), F.col("root").alias("cls"))
    return fixpoint(seed, lambda d: d.join(sub, "cls").select("root", F.col("child").alias("cls")), key=["root", "cls"])


def depths(roots: DataFrame, sub: DataFrame) -> DataFrame:
    """(root, depth): classes on the longest way down from each root, itself
    included, over ``sub`` (child, parent).  Heights grow from the leaves: a
    round settles the classes whose children are all settled, so a class is
    settled once, whatever the number of ways to it.  A root above a cycle has
    no finite depth: null."""
    roots, open_ = cut(roots.select("root")), cut(sub.select("parent", "child").distinct())
    nodes = open_.select(F.col("parent").alias("node")).unionByName(open_.select(F.col("child").alias("node"))).unionByName(
        roots.select(F.col("root").alias("node"))).distinct()
    done = cut(nodes.join(open_.select(F.col("parent").alias("node")), "node", "left_anti").withColumn("depth", F.lit(1)))
    for level in count(1):
        known = open_.join(done.select(F.col("node").alias("child"), "depth"), "child", "left")
        ready = known.groupBy("parent").agg(F.count_if(F.col("depth").isNull()).alias("wait"), F.max("depth").alias("below"))
        new = cut(ready.filter("wait = 0").select(F.col("parent").alias("node"), (F.col("below") + 1).alias("depth")))
        if new.isEmpty():
            break
        done = done.unionByName(new)  # parts that are cut; the union itself every few levels
        done = cut(done) if level % CHECKPOINT_EVERY == 0 else done
        open_ = cut(open_.join(new.select(F.col("node").alias("parent")), "parent", "left_anti"))
    return roots.select("root").distinct().join(done.withColumnRenamed("node", "root"), "root", "left")


def construct(bindings: DataFrame, templates: list[tuple]) -> DataFrame:
    """``CONSTRUCT {templates}``: each solution yields one triple per template;
    a template with an unbound variable yields nothing; the result is a set.
    Template terms: ``?var`` or a constant (an ``(value, kind)`` tuple for a
    typed/literal constant)."""
    def term(t):
        if is_var(t):
            return F.col(t[1:]), F.lit("iri")
        if isinstance(t, tuple):
            return F.lit(t[0]), F.lit(t[1])
        return F.lit(t), F.lit("iri")

    structs = []
    for s, p, o in templates:
        (sv, _), (pv, _), (ov, ok) = term(s), term(p), term(o)
        structs.append(F.struct(sv.alias("s"), pv.alias("p"), ov.alias("o"), ok.alias("o_kind")))
    out = bindings.select(F.explode(F.array(*structs)).alias("t")).select("t.*")
    return out.filter(F.col("s").isNotNull() & F.col("p").isNotNull() & F.col("o").isNotNull()).distinct()


# --- ontology statistics -------------------------------------------------------------

def graph_stats(triples: DataFrame, by: list[str] | None = None) -> DataFrame:
    """classes = subjects typed Class ∪ subjects of subClassOf; properties and
    individuals = subjects typed ObjectProperty / NamedIndividual; triples =
    size of the triple *set* (without those that lack a term); for each graph
    named by the columns ``by``.  The triples are dealt out before equal ones are
    dropped, so that a task holds those of its partition, whatever the size of the
    files; the subjects of the set are counted by a second grouping."""
    by, terms = by or [], ["s", "p", "o", "o_kind", "lang"]
    each = triples.select(*by, *terms).repartition(*by, *terms).distinct()
    typed = lambda cls: (F.col("p") == "type") & (F.col("o") == cls)
    marks = {"classes": typed("Class") | (F.col("p") == "subClassOf"), "properties": typed("ObjectProperty"), "individuals": typed("NamedIndividual")}
    complete = reduce(Column.__and__, [F.col(t).isNotNull() for t in terms])
    subjects = each.groupBy(*by, "s").agg(*[F.max(F.col("s").isNotNull() & mark).alias(name) for name, mark in marks.items()],
                                          F.count_if(complete).alias("triples"))
    return subjects.groupBy(*by).agg(*[F.count_if(name).alias(name) for name in marks], F.coalesce(F.sum("triples"), F.lit(0)).alias("triples"))
