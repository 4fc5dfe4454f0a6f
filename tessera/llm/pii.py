"""Personal data with offset-preserving deobfuscation.

*Base* spans are found in the text as it is: e-mail addresses, IPv4 addresses,
card numbers that pass Luhn, international phone numbers.  *Added* spans are
found in a normalised form of the text and mapped back to source characters.
The normaliser is a chain of two transducers, each of which keeps, for every
character it writes, the source characters it stands for:

1. characters: full-width and other compatible forms, look-alikes of Latin
   letters, digits of any script, odd spaces and dashes; invisible ones vanish;
2. disguises: bracketed ``[at]`` / ``(dot)``, ``name at host.tld`` (the whole host,
   its dots plain, bracketed or spelled in any mix; what tells it from prose is
   said in ``_told_as_address``), and runs of three or more spelled digits (with
   ``dot`` and ``plus`` inside a run).

An added span is kept unless a base span of its kind overlaps it without lying
wholly inside it; equal spans are reported once, as base.

Defined cases: null texts are empty; spans of one kind never overlap within
one pass; offsets are code points, end exclusive; repeated rows are judged one
by one; scanning is linear in the text, also in long runs of one character; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# The detectors of the contract, written so that no run of characters is scanned twice.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Look-alikes (source characters, then the Latin ones they imitate, in order).
LOOK_ALIKES = dict(zip(
    "авекмнорстухіјѕԁһԛԝАВЕКМНОРСТУХІЈЅαεικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧɑɡıⅼ․。｡∙‐‑‒–—−﹣",
    "abekmhopctyxijsdhqwABEKMHOPCTYXIJSaeikvoptuxABEZHIKMNOPTYXagil....-------"))
INVISIBLE = frozenset("­​‌‍⁠﻿‎‏")
# Spelled digits 0-9 in the languages of the corpus.
SPELLED = [
    "zero one two three four five six seven eight nine".split(),
    "zéro un deux trois quatre cinq six sept huit neuf".split(),
    "null eins zwei drei vier fünf sechs sieben acht neun".split(),
    "cero uno dos tres cuatro cinco seis siete ocho nueve".split(),
]
VALUE = {w: str(d) for words in SPELLED for d, w in enumerate(words)}
_W = "(?:" + "|".join(sorted(VALUE, key=lambda w: (-len(w), w))) + ")"
_DOT = r"(?:dot|point|punkt|punto)"
_GAP = r"[\s,-]{0,3}"
RUN = re.compile(rf"\b(?:plus{_GAP})?{_W}(?:(?:[\s,-]{{1,3}}{_DOT})?[\s,-]{{1,3}}{_W}){{2,}}\b", re.I)
RUN_PART = re.compile(rf"(?P<plus>plus{_GAP})|(?P<dot>[\s,-]{{1,3}}{_DOT}[\s,-]{{1,3}})|(?P<digit>{_W})|(?P<gap>[\s,-]{{1,3}})", re.I)
# Between two labels of a host: a dot that is plain, bracketed or spelled.
_ANY_DOT = rf"(?:\.|[ \t]{{0,3}}[\[({{<][ \t]{{0,2}}(?:{_DOT}|\.)[ \t]{{0,2}}[\])}}>][ \t]{{0,3}}|[ \t]{{1,3}}{_DOT}[ \t]{{1,3}})"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?+"
_TLD = r"(?:[A-Za-z]{2,63}|xn--[A-Za-z0-9-]{1,59})"
# Last labels of hosts (generic ones, then those of countries).
SUFFIXES = frozenset("""
com org net edu gov mil int info biz name pro io ai app dev xyz online site tech store blog shop club cloud page live media news email
ac ad ae ar at au az ba be bg br by ca ch cl cn co cr cu cy cz de dk do ec ee eg es eu fi fr ge gr hk hr hu id ie il in ir is it jo jp ke kr kz
lb li lk lt lu lv ma mc md me mk mt mx my ng nl no np nz om pa pe ph pk pl pt py qa ro rs ru sa se sg si sk sn th tn tr tv tw ua ug uk us uy uz
ve vn za""".split())
# Words that "at" follows in running text, and words that an address follows.
BEFORE_AT = frozenset("""
all am and are arrive arrived arrives be been being bought but buy call called came come find found get go goes going gone good had has have held
here home is it join joined kept laugh laughed learn least live lived lives look looked looking looks made meet meeting meets met not now on only
or order ordered out play played point read said sat see seen she shop sit smiled sold staff start started stay stayed stop stopped stood stand
stands study studied team that them then there they this throw time up us visit visited was we went were work worked working works you""".split())
CUES = frozenset("address contact e-mail email is mail me or reach reached send sent to via write write".split())
# A whole host (at most 127 labels, as names have): the last label is alphabetic, and no label or address goes on after it.
HOST = rf"{_LABEL}(?:{_ANY_DOT}{_LABEL}){{0,125}}?{_ANY_DOT}{_TLD}(?!-*[A-Za-z0-9@])(?!{_ANY_DOT}[A-Za-z0-9])"
AT = (r"(?P<at>[ \t]{0,3}[\[({<][ \t]{0,2}(?:at|@|arroba)[ \t]{0,2}[\])}>][ \t]{0,3}"
      rf"|(?<=[A-Za-z0-9._%+-])[ \t]{{1,3}}at[ \t]{{1,3}}(?={HOST}))")
DOT = (rf"(?P<dot>[ \t]{{0,3}}[\[({{<][ \t]{{0,2}}(?:{_DOT}|\.)[ \t]{{0,2}}[\])}}>][ \t]{{0,3}}"
       rf"|(?<=[A-Za-z0-9])[ \t]{{1,3}}{_DOT}[ \t]{{1,3}}(?=[A-Za-z0-9]))")
SIGNS = re.compile(f"{AT}|{DOT}", re.I)
WHOLE_HOST = re.compile(HOST, re.I)
LAST_LABEL = re.compile(r"[A-Za-z0-9-]+$")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _byte(digits: str) -> bool:
    """At most 255, whatever the number of leading zeros."""
    significant = digits.lstrip("0")
    return len(significant) < 3 or len(significant) == 3 and significant <= "255"


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part is the run before an @, back to the last match's end."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        else:
            end = max(end, at)  # nothing before this @ can belong to a later match
        at = text.find("@", max(at + 1, end))


def detect(text: str) -> list[Span]:
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(_byte(x) for x in m.group().split("."))]
        found += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return found


def _plain(c: str) -> str:
    """The ASCII that a character stands for, or itself."""
    if c < "\x80" or c in "éèàâêîôûçäöüßñáíóú":
        return c
    if c in INVISIBLE:
        return ""
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    if (d := unicodedata.decimal(c, None)) is not None:
        return str(d)
    folded = unicodedata.normalize("NFKC", c)
    if folded.isspace():
        return " "
    return folded if folded.isascii() and len(folded) == 1 else c


_PLAIN: dict[str, str] = {}


def fold_characters(text: str) -> tuple[str, list[int]] | None:
    """(text, source index of each character), or None when nothing changes."""
    if text.isascii():
        return None
    for c in set(text).difference(_PLAIN):
        _PLAIN[c] = _plain(c)
    odd = {c for c in set(text) if _PLAIN[c] != c}
    if not odd:
        return None
    kept = [(p, i) for i, c in enumerate(text) if (p := _PLAIN[c] if c in odd else c)]
    return "".join(p for p, _ in kept), [i for _, i in kept]


def _told_as_address(text: str, at: re.Match) -> bool:
    """Whether ``name at host`` without brackets is meant as an address.  The host
    must end in a known suffix (not in a word that begins a sentence).  Then a dot
    that is spelled or bracketed tells it, or a name that no word looks like; a
    plain word is one only after a cue: the text's or sentence's begin, punctuation
    or a word that an address follows, and when "at" does not follow it in prose."""
    host = WHOLE_HOST.match(text, at.end()).group()
    last = LAST_LABEL.search(host).group()
    if last.lower() not in SUFFIXES and not last.lower().startswith("xn--") or last[0].isupper() and last[1:].islower():
        return False
    start = at.start()
    while start > 0 and text[start - 1] in LOCAL:
        start -= 1
    name = text[start:at.start()]
    if not any(c.isalpha() for c in name):
        return False
    if any(c in "[({< \t" for c in host) or any(c in "0123456789._%+-" for c in name):
        return True
    before = text[max(0, start - 24):start].rstrip(" \t")
    cue = not before or not (before[-1].isalnum() or before[-1] in "-'’") or re.split(r"[^\w-]", before)[-1].lower() in CUES
    return cue and name.lower() not in BEFORE_AT


def undo_disguises(text: str) -> tuple[str, list[int], list[int]] | None:
    """(text, first and last source index of each character), or None."""
    edits: list[tuple[int, int, str]] = []
    for m in SIGNS.finditer(text):
        if m.lastgroup == "at" and m.group().strip(" \t").lower() == "at" and not _told_as_address(text, m):
            continue
        edits.append((m.start(), m.end(), "@" if m.lastgroup == "at" else "."))
    for m in RUN.finditer(text):
        for p in RUN_PART.finditer(text, m.start(), m.end()):
            char = {"plus": "+", "dot": ".", "gap": ""}.get(p.lastgroup, VALUE.get(p.group().lower(), ""))
            edits.append((p.start(), p.end(), char))
    if not edits:
        return None
    # parts of a run win over the signs they overlap
    edits.sort()
    out, first, last, at = [], [], [], 0
    for a, b, c in edits:
        if a < at:
            continue
        out.append(text[at:a] + c)
        first += [*range(at, a), *[a] * len(c)]
        last += [*range(at, a), *[b - 1] * len(c)]
        at = b
    out.append(text[at:])
    first += range(at, len(text))
    last += range(at, len(text))
    return "".join(out), first, last


def added_spans(text: str, base: list[Span]) -> list[Span]:
    folded = fold_characters(text)
    plain, source = folded or (text, None)
    undone = undo_disguises(plain)
    if folded is None and undone is None:
        return []
    shown, first, last = undone or (plain, range(len(plain)), range(len(plain)))
    by_kind = {k: [(a, b) for kind, a, b in base if kind == k] for k in KINDS}
    out = []
    for kind, s, e in detect(shown):
        a, b = first[s], last[e - 1]
        a, b = (source[a], source[b] + 1) if source else (a, b + 1)
        over = [(x, y) for x, y in by_kind[kind] if x < b and a < y]
        if all(a <= x and y <= b and (x, y) != (a, b) for x, y in over):
            out.append((kind, a, b))
    return out


def find(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: (doc, found array<struct<kind,from,to,added>>),
    by kind as in ``KINDS``, then start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_no = {k: i for i, k in enumerate(KINDS)}
        struct = pa.list_(pa.struct([("kind", pa.string()), ("from", pa.int32()), ("to", pa.int32()), ("added", pa.bool_())]))
        for batch in batches:
            rows = []
            for t in batch.column(1).to_pylist():
                base = detect(t or "")
                spans = [(*s, False) for s in base] + [(*s, True) for s in added_spans(t or "", base)]
                spans.sort(key=lambda s: (kind_no[s[0]], s[1], s[2]))
                rows.append([dict(zip(("kind", "from", "to", "added"), s)) for s in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, struct)], names=[doc, "found"])

    src = docs.select(F.col(doc).cast("long").alias(doc), F.col(text).cast("string").alias("_t"))
    return src.mapInArrow(run, f"`{doc}` long, found array<struct<kind:string,from:int,to:int,added:boolean>>")
