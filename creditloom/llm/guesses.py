"""Secret scans: fixed patterns, and how many guesses a value beside a credential's name would take.

Patterns give the base spans.  Beyond them, whatever stands as the value of a credential's name
(``CONTEXT``) is judged by its guess cost: the cheapest way to cut it into

- words of a public vocabulary, by rank, with the ways to capitalise them,
- dates and years,
- repeats of a unit of one to four characters,
- walks over neighbouring keys or along the alphabet or the digits,
- brute-force spans, character by character from the class that each belongs to,

every span costing SPAN more.  Costs are decimal logarithms of guesses; a table holds the cheapest
way to reach each character, so a value takes time in proportion to its length.  Repeats and walks
begin where their run begins.  A value of GUESSES or more is a span of kind ``guess``, unless a base
span of kind ``assign`` covers some of it.

Spans count code points of the whole text, the end exclusive.  One pass without shuffle.

Edge cases: null and empty texts have no spans; other columns ride along in ``row``, whatever they
are called; repeated rows are judged alike; an empty table gives no rows; bytes that are no UTF-8
count by their lead bytes.
"""

import json
import re
from functools import lru_cache
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.text import annotate, kept, word_table, words

# Fixed values.
KINDS = ["assign", "access", "hex", "guess"]
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HINTS = [b"pass", b"pwd", b"secret", b"token", b"key", b"credential", b"auth"]
CONTEXT = re.compile(
    rb"(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private)[_-]?key|credentials?|auth)"
    rb"[\"']?(?:\x20*[:=]\x20*|\x20is\x20)(?:\"([^\"\n]+)\"|'([^'\n]+)'|([^\s\"']+))",
    re.I,
)
LEAST = {"assign": 12, "access": 18, "hex": 16}
DATES = [
    re.compile(p)
    for p in (
        r"(?:19|20)\d\d", r"(?:19|20)\d\d(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])", r"\d\d(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])",
        r"(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])(?:19|20)?\d\d", r"(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])(?:19|20)?\d\d",
        r"(?:19|20)\d\d[-/._](?:0?[1-9]|1[0-2])[-/._](?:0?[1-9]|[12]\d|3[01])",
        r"(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|[12]\d|3[01])[-/._](?:19|20)?\d\d",
    )
]
ROWS = ["`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./"]

GUESSES = 10.0
SPAN = log10(2)
YEARS = 120
LONGEST_DATE = 10
LONGEST_UNIT = 4
LONGEST_WORD = 24
LEAST_WORD = 3
LEAST_WALK = 3


def _neighbours() -> dict[str, dict[str, int]]:
    """Of each key, its neighbours and the direction they lie in; a row is half a key right of the one above."""
    place = {key: (2 * x + y, y) for y, row in enumerate(ROWS) for x, key in enumerate(row)}
    at = {p: key for key, p in place.items()}
    ways = [(-2, 0), (2, 0), (-1, -1), (1, -1), (-1, 1), (1, 1)]
    return {key: {at[x + dx, y + dy]: k for k, (dx, dy) in enumerate(ways) if (x + dx, y + dy) in at} for key, (x, y) in place.items()}


KEYS = _neighbours()
TURN, START = log10(4), log10(len(KEYS))


def ranks(path: str) -> dict[str, int]:
    """Whole words of a tokenizers file of a vocabulary with word ends, by their place in it, from 1."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    whole = [w[:-4] for w, _ in sorted(vocabulary.items(), key=lambda x: x[1]) if w.endswith("</w>")]
    usable = [w for w in whole if w.isalpha() and LEAST_WORD <= len(w) <= LONGEST_WORD]
    return {w: k + 1 for k, w in enumerate(usable)}


@lru_cache(maxsize=4096)
def brute(char: str) -> float:
    """The class that a character is guessed from."""
    if "0" <= char <= "9":
        return 1.0
    if "a" <= char.lower() <= "z":
        return log10(26)
    return log10(33) if char < "\x80" else 2.0


def lowered(value: str) -> str:
    """Lower case, character by character; what would become two stays."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in value)


def capitals(word: str) -> float:
    """The ways to capitalise a word as this one is."""
    upper = sum(c != c.lower() for c in word)
    if not upper:
        return 0.0
    return log10(2) if upper == len(word) or (upper == 1 and word[0] != word[0].lower()) else len(word) * log10(2)


def step(a: str, b: str) -> int | None:
    """The direction of a walk from one character to the next: on the keyboard, or up or down in the alphabet or the digits."""
    if a.isascii() and b.isascii() and a.isalnum() and b.isalnum() and a.isdigit() == b.isdigit() and abs(ord(a) - ord(b)) == 1:
        return 6 if b > a else 7
    return KEYS.get(a, {}).get(b)


def guess_cost(value: str, rank: dict[str, int]) -> float:
    """The decimal logarithm of the guesses that the cheapest cut of ``value`` takes."""
    n, low = len(value), lowered(value)
    best = [0.0] * (n + 1)
    by_force = float("inf")  # the cheapest way whose last span is brute force
    equal = [0] * (LONGEST_UNIT + 1)  # so many characters back are each equal to the one a unit before
    walk_from, turns, way = 0, 0, None
    for i in range(1, n + 1):
        char = value[i - 1]
        by_force = min(by_force, best[i - 1] + SPAN) + brute(char)
        cost = by_force
        for length in range(LEAST_WORD, min(LONGEST_WORD, i) + 1):
            if place := rank.get(low[i - length : i]):
                cost = min(cost, best[i - length] + SPAN + log10(place) + capitals(value[i - length : i]))
        if char.isdigit():
            for length in range(4, min(LONGEST_DATE, i) + 1):
                part = value[i - length : i]
                if part[0].isdigit() and any(p.fullmatch(part) for p in DATES):
                    cost = min(cost, best[i - length] + SPAN + log10(YEARS if length == 4 else 365 * YEARS))
        for unit in range(1, LONGEST_UNIT + 1):
            equal[unit] = equal[unit] + 1 if i > unit and char == value[i - 1 - unit] else 0
            times = equal[unit] // unit + 1
            if times > 1 and times * unit > 2:
                cost = min(cost, best[i - times * unit] + SPAN + sum(map(brute, value[i - unit : i])) + log10(times))
        now = step(low[i - 2], low[i - 1]) if i > 1 else None
        if now is None:
            walk_from, turns = i - 1, 0
        elif now != way:
            turns += 1
        way = now
        if i - walk_from >= LEAST_WALK:
            cost = min(cost, best[walk_from] + SPAN + START + log10(i - walk_from) + turns * TURN)
        best[i] = cost
    return best[n]


def values(data: bytes) -> list[tuple[int, int]]:
    """Bounds of the values beside a credential's name; of a bare one, without the marks that end a sentence."""
    out = []
    for m in CONTEXT.finditer(data):
        k = m.lastindex
        begin, end = m.span(k)
        if k == 3:
            end = begin + len(m[3].rstrip(b".,;:!?)]}"))
        if end > begin:
            out.append((begin, end))
    return out


SPANS = "spans array<struct<kind:string,start:long,end:long,guesses:double>>"
_HEX = word_table(bytes(sorted({*range(256)} - {*b"0123456789abcdef"})))


def scan(docs: DataFrame, vocabulary: str, keep: list[str] | None = None, guesses: float = GUESSES) -> DataFrame:
    """``row`` (the columns ``keep``, or all) and the spans of every text, by start, then kind as in KINDS.

    ``vocabulary``: a tokenizers file whose words are in the order of their use.  ``guesses`` of a
    span is null for base spans.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("guesses", pa.float64())]))

    def run(rows: pa.RecordBatch, raw: np.ndarray, off: np.ndarray) -> list:
        rank = kept(("guesses", vocabulary), lambda: ranks(vocabulary))
        starts, ends, first = words(raw, off, _HEX)
        long = ends - starts >= LEAST["hex"]
        data, out = raw.tobytes(), []
        for k, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
            text = data[a:b]
            own = slice(int(first[k]), int(first[k + 1]))
            found = [(int(s) - a, 2, int(e) - a, None) for s, e in zip(starts[own][long[own]], ends[own][long[own]])]
            if b"AKIA" in text:
                found += [(m.start(), 1, m.end(), None) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
            low = text.lower()
            if any(x in low for x in HINTS):
                assigned = [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
                found += [(s, 0, e, None) for s, e in assigned]
                at = 0
                for s, e in values(text):
                    while at < len(assigned) and assigned[at][1] <= s:
                        at += 1
                    if at < len(assigned) and assigned[at][0] < e:
                        continue
                    cost = guess_cost(text[s:e].decode("utf-8", "replace"), rank)
                    if cost >= guesses:
                        found.append((s, 3, e, cost))
            if found:
                points = np.zeros(len(text) + 1, np.int64)
                np.cumsum((raw[a:b] & 0xC0) != 0x80, out=points[1:])
                found = [(int(points[s]), k, int(points[e]), g) for s, k, e, g in found]
            out.append([{"kind": KINDS[k], "start": s, "end": e, "guesses": g} for s, k, e, g in sorted(found, key=lambda x: x[:3])])
        return [pa.array(out, kind)]

    return annotate(docs, run, SPANS, keep)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, with commas between."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def masked(scanned: DataFrame, mask: str = "[secret]") -> DataFrame:
    """The rows behind ``scanned`` (with all their columns), every span of their texts replaced by ``mask``; what overlaps is one."""
    union = F.aggregate(
        "spans", F.array().cast("array<struct<start:long,end:long>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))),
    )
    text = F.col("row.text").cast("string")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(F.col("gone"), lambda x: x["end"]))
    starts = F.concat(F.transform(F.col("gone"), lambda x: x["start"]), F.array(F.length(text).cast("long")))
    parts = F.zip_with(ends, starts, lambda e, s: F.substr(text, (e + 1).cast("int"), (s - e).cast("int")))
    new = F.when(F.size("gone") > 0, F.array_join(parts, mask)).otherwise(F.col("row.text"))
    found = scanned.withColumn("gone", union)
    names = scanned.schema["row"].dataType.names
    return found.select(*[(new if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in names])
