"""RDF triple files <-> the triple table ``(s, p, o, o_kind, lang, dtype)``.

N-Triples is line based, so reading and writing are native column
expressions over ``read.text`` / ``write.text`` (a file splits across tasks
like any text file).  RDF/XML documents (up to the 2 GB of a binary row) are read
one file per row through Spark's file systems and parsed by a pull parser that
drops each node element once its triples are out; the writer makes documents of
bounded size.  ``read_triples`` chooses by the extension.  Both yield a triple
*set* (``distinct``); blank nodes are named by their file, so those of two files
stay apart; a literal keeps its language tag and datatype."""

from __future__ import annotations

import io
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_NS = "http://example.org/t#"
NT_LINE = (
    r'^\s*(<[^>]*>|_:\S+)\s+(<[^>]*>)\s+'
    r'(?:(<[^>]*>|_:\S+)|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?)\s*\.\s*$'
)


TRIPLE = "s string, p string, o string, o_kind string, lang string, dtype string"
XML_SUFFIXES = ("rdf", "owl", "xml")
#: Lines and bytes of a written RDF/XML document: one is read whole by one task.
DOCUMENT_LINES, DOCUMENT_BYTES = 50_000, 32 << 20
LINES_AT_ONCE = 1_000
# The escapes of N-Triples literals, besides the backslash's own and code points.
ESCAPES = {"\\t": "\t", "\\b": "\b", "\\n": "\n", "\\r": "\r", "\\f": "\f", '\\"': '"', "\\'": "'"}


def _escape(c: Column) -> Column:
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for short in ('\\"', "\\n", "\\r", "\\t"):
        out = F.replace(out, F.lit(ESCAPES[short]), F.lit(short))
    return out


def _code_points(c: Column) -> Column:
    """``\\uXXXX`` and ``\\UXXXXXXXX`` as the characters they name."""
    codes = F.array_distinct(F.regexp_extract_all(c, F.lit(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8})"), 1))
    char = lambda code: F.decode(F.unhex(F.lpad(F.substring(code, 2, 8), 8, "0")), "UTF-32")
    return F.aggregate(codes, c, lambda done, code: F.replace(done, F.concat(F.lit("\\"), code), char(code)))


def _unescape(c: Column) -> Column:
    out = F.replace(c, F.lit("\\\\"), F.lit("\u0000"))  # first, so that no other escape begins in it
    for short, char in ESCAPES.items():
        out = F.replace(out, F.lit(short), F.lit(char))
    return F.replace(_code_points(out), F.lit("\u0000"), F.lit("\\"))


def _dtype(triples: DataFrame) -> Column:
    return F.coalesce(F.col("dtype"), F.lit("")) if "dtype" in triples.columns else F.lit("")


def to_ntriples(triples: DataFrame, ns: str = DEFAULT_NS) -> DataFrame:
    """One N-Triples line per triple (column ``line``)."""
    iri = lambda c: F.concat(F.lit("<" + ns), c, F.lit(">"))
    tag = F.when(F.col("lang") != "", F.concat(F.lit("@"), F.col("lang"))).when(
        _dtype(triples) != "", F.concat(F.lit("^^<"), _dtype(triples), F.lit(">"))).otherwise(F.lit(""))
    lit = F.concat(F.lit('"'), _escape(F.col("o")), F.lit('"'), tag)
    obj = F.when(F.col("o_kind") == "lit", lit).otherwise(iri(F.col("o")))
    return triples.select(F.concat_ws(" ", iri(F.col("s")), iri(F.col("p")), obj, F.lit(".")).alias("line"))


def write_ntriples(triples: DataFrame, path: str, ns: str = DEFAULT_NS) -> None:
    to_ntriples(triples, ns).write.mode("overwrite").text(path)


def _local(c: Column, ns: str) -> Column:
    """Strip <> and the namespace from an IRI term; blank nodes keep ``_:``."""
    bare = F.regexp_replace(c, r"^<|>$", "")
    return F.when(F.startswith(bare, F.lit(ns)), F.substring(bare, len(ns) + 1, 1 << 30)).otherwise(bare)


def _scope(file: Column) -> Column:
    return F.concat(F.lit("_:f"), F.hex(F.xxhash64(file)), F.lit("_"))


def _scoped(term: Column) -> Column:
    """Blank nodes of two files are different nodes: prefix them by their file."""
    return F.when(F.startswith(term, F.lit("_:")), F.concat("scope", F.substring(term, 3, 1 << 30))).otherwise(term)


def _nt_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", F.input_file_name().alias("file"))


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, value) of the lines that are no triple, neither blank nor a comment."""
    return _nt_lines(spark, path).filter(~F.col("value").rlike(NT_LINE) & ~F.col("value").rlike(r"^\s*(#.*)?$")).select("file", "value")


def read_ntriples(spark: SparkSession, path: str, ns: str = DEFAULT_NS) -> DataFrame:
    """The triples of all lines that hold one (``rejected_lines`` tells the others)."""
    lines = _nt_lines(spark, path).select("value", _scope(F.col("file")).alias("scope"))
    g = lambda i: F.regexp_extract("value", NT_LINE, i)
    term = lambda c: _scoped(_local(_code_points(c), ns))
    parsed = lines.filter(F.col("value").rlike(NT_LINE)).select(
        term(g(1)).alias("s"), _local(_code_points(g(2)), ns).alias("p"), (g(3) != "").alias("is_iri"), term(g(3)).alias("o_iri"),
        g(4).alias("o_lit"), g(5).alias("lang"), g(6).alias("dtype"))
    pick = lambda iri, lit: F.when(F.col("is_iri"), iri).otherwise(lit)
    return parsed.select(
        "s", "p", pick(F.col("o_iri"), _unescape(F.col("o_lit"))).alias("o"), pick(F.lit("iri"), F.lit("lit")).alias("o_kind"),
        pick(F.lit(""), F.col("lang")).alias("lang"), pick(F.lit(""), F.col("dtype")).alias("dtype")).distinct()


# --- RDF/XML -------------------------------------------------------------------------

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
_XML = "{http://www.w3.org/XML/1998/namespace}"
XML_LANG = _XML + "lang"


def _rdf(name: str) -> str:
    return f"{{{RDF}}}{name}"


class _Document:
    """Triples of one RDF/XML document: node and property elements, rdf:about / ID /
    nodeID / resource / datatype / li, property attributes, nested nodes, parseType
    Collection and Resource, xml:lang and xml:base.  ``name`` scopes its blank nodes."""

    def __init__(self, name: str, base: str):
        self.name, self.base, self.blanks = name, base, 0
        self.out: list[tuple] = []

    def blank(self) -> str:
        self.blanks += 1
        return f"{self.name}b{self.blanks}"

    def iri(self, ref: str) -> str:
        return self.base + ref if not ref or ref.startswith("#") else ref

    def add(self, s: str, p: str, o: str, kind: str = "iri", lang: str = "", dtype: str = "") -> None:
        self.out.append((s, p, o, kind, lang, dtype))

    def named(self, element) -> str | None:
        at = element.attrib
        if _rdf("about") in at:
            return self.iri(at[_rdf("about")])
        if _rdf("ID") in at:
            return f"{self.base}#{at[_rdf('ID')]}"
        return f"{self.name}n{at[_rdf('nodeID')]}" if _rdf("nodeID") in at else None

    def node(self, element, lang: str) -> str:
        s = self.named(element) or self.blank()
        lang = element.attrib.get(XML_LANG, lang)
        if element.tag != _rdf("Description"):
            self.add(s, RDF + "type", _qname(element.tag))
        for name, value in element.attrib.items():
            if name == _rdf("type"):
                self.add(s, RDF + "type", self.iri(value))
            elif not name.startswith((f"{{{RDF}}}", _XML)):
                self.add(s, _qname(name), value, "lit", lang)
        self.properties(s, element, lang)
        return s

    def properties(self, s: str, element, lang: str) -> None:
        items = 0
        for prop in element:
            p = _qname(prop.tag)
            if prop.tag == _rdf("li"):
                items += 1
                p = f"{RDF}_{items}"
            self.property(s, p, prop, prop.attrib.get(XML_LANG, lang))

    def property(self, s: str, p: str, prop, lang: str) -> None:
        at = prop.attrib
        if _rdf("resource") in at:
            self.add(s, p, self.iri(at[_rdf("resource")]))
        elif _rdf("nodeID") in at:
            self.add(s, p, f"{self.name}n{at[_rdf('nodeID')]}")
        elif at.get(_rdf("parseType")) == "Collection":
            head = RDF + "nil"
            for item in reversed([self.node(child, lang) for child in prop]):
                cell = self.blank()
                self.add(cell, RDF + "first", item)
                self.add(cell, RDF + "rest", head)
                head = cell
            self.add(s, p, head)
        elif at.get(_rdf("parseType")) == "Resource":
            inner = self.blank()
            self.add(s, p, inner)
            self.properties(inner, prop, lang)
        elif len(prop):
            self.add(s, p, self.node(prop[0], lang))
        else:
            dtype = at.get(_rdf("datatype"), "")
            self.add(s, p, prop.text or "", "lit", "" if dtype else lang, dtype)


def _qname(tag: str) -> str:
    return tag[1:].replace("}", "") if tag.startswith("{") else tag


def xml_triples(data: bytes, name: str, base: str) -> Iterator[list[tuple]]:
    """The triples of a document, a node element at a time."""
    document, path, lang = _Document(name, base), [], ""
    for event, element in ElementTree.iterparse(io.BytesIO(data), events=("start", "end")):
        if event == "start":
            if not path:
                document.base, lang = element.attrib.get(_XML + "base", base), element.attrib.get(XML_LANG, "")
            path.append(element)
            continue
        path.pop()
        inside = len(path) == 1 and path[0].tag == _rdf("RDF")
        if inside or not path and element.tag != _rdf("RDF"):
            document.node(element, lang)
            yield document.out
            document.out = []
        if inside:
            path[0].clear()  # what has been read of the document goes


def read_rdfxml(spark: SparkSession, path: str, ns: str = DEFAULT_NS) -> DataFrame:
    """Every RDF/XML file at ``path`` (a file, a folder or a glob), as a triple set."""
    files = spark.read.format("binaryFile").load(path).select(_scope(F.col("path")).alias("name"), "path", "content")
    names = [f.split()[0] for f in TRIPLE.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base, content in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows: list[tuple] = []
                for more in xml_triples(content, name, base):
                    rows += more
                    if len(rows) > 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=names)

    found = files.mapInArrow(parse, TRIPLE)
    local = lambda c: _local(F.col(c), ns)
    return found.select(local("s").alias("s"), local("p").alias("p"), F.when(F.col("o_kind") == "iri", local("o")).otherwise(F.col("o")).alias("o"),
                        "o_kind", "lang", "dtype").distinct()


def write_rdfxml(triples: DataFrame, path: str, ns: str = DEFAULT_NS) -> None:
    """RDF/XML documents of at most ``DOCUMENT_LINES`` lines and about ``DOCUMENT_BYTES``
    bytes, as many as a partition needs; predicates must be XML names.  Every file but
    a task's last has exactly so many lines, which is where Spark begins the next;
    a document full by its bytes gets blank ones."""
    def safe(c: Column) -> Column:
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;"), ("\n", "&#10;"), ("\t", "&#9;")):
            c = F.replace(c, F.lit(char), F.lit(entity))
        return c

    dtype = _dtype(triples)
    tag = F.when(F.col("lang") != "", F.concat(F.lit(' xml:lang="'), F.col("lang"), F.lit('"'))).when(
        dtype != "", F.concat(F.lit(' rdf:datatype="'), safe(dtype), F.lit('"'))).otherwise(F.lit(""))
    resource = F.concat(F.lit(f' rdf:resource="{ns}'), safe(F.col("o")), F.lit('"/>'))
    literal = F.concat(tag, F.lit(">"), safe(F.col("o")), F.lit("</t:"), F.col("p"), F.lit(">"))
    line = F.concat(F.lit(f'<rdf:Description rdf:about="{ns}'), safe(F.col("s")), F.lit('"><t:'), F.col("p"),
                    F.when(F.col("o_kind") == "lit", literal).otherwise(resource), F.lit("</rdf:Description>"))

    def document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = lambda *lines: pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        head, tail = f'<rdf:RDF xmlns:rdf="{RDF}" xmlns:t="{ns}">', "</rdf:RDF>"
        yield some(head)
        left, size = DOCUMENT_LINES - 2, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                if size > DOCUMENT_BYTES:
                    yield some(*[""] * left)
                    left = 0
                if not left:
                    yield some(tail, head)
                    left, size = DOCUMENT_LINES - 2, 0
                part = batch.slice(at, min(left, LINES_AT_ONCE))
                yield part
                at, left, size = at + part.num_rows, left - part.num_rows, size + part.nbytes
        yield some(tail)

    triples.select(line.alias("value")).mapInArrow(document, "value string").write.mode("overwrite").option(
        "maxRecordsPerFile", DOCUMENT_LINES).text(path)


def read_triples(spark: SparkSession, path: str, ns: str = DEFAULT_NS) -> DataFrame:
    """The triples at ``path``, its format told by the extension: ``.rdf``, ``.owl``
    and ``.xml`` are RDF/XML, everything else is N-Triples (a folder of parts has
    the extension of its name)."""
    xml = path.rstrip("/").rsplit(".", 1)[-1].lower() in XML_SUFFIXES
    return read_rdfxml(spark, path, ns) if xml else read_ntriples(spark, path, ns)
