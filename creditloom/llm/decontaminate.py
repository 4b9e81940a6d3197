"""Benchmark decontamination: training texts against a broadcast hash set of benchmark n-grams.

A benchmark item becomes the windows of ``n`` consecutive normalised words (a shorter item: one
window of all its words).  ``mark`` scans the whole text of each document: words that no window
holds rule out nearly all positions, the rest is looked up by window hash, and each hit is compared
word by word before it counts.  ``clean`` then takes out hit spans or whole documents.

The benchmark is measured first.  Up to ``most_bytes`` of text it is broadcast; what a worker then
holds is about ten times that.  A larger one is dealt into as many parts as that bound asks for,
and the documents are scanned once for each part, one part in memory at a time; hits add up.

Edge cases: null or empty texts and items, and those without words, have no windows and no hits;
repeated rows and items are judged alike, each item counting by its id; a null item id is never
listed but its windows hit; an empty benchmark leaves all clean; other columns ride along in
``row``, whatever they are called.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.text import annotate, kept, lower_ascii, prefix_hash, range_hash, slices, windows, word_table, words
from creditloom.sources.tables import materialise

WINDOW = 10
MOST_BYTES = 16_000_000

#: Words are runs of letters, digits and non-ASCII bytes.
WORDS = word_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))

MARKS = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def normalised(raw: np.ndarray, off: np.ndarray):
    """Lower-cased bytes and their words' starts, ends, first-of-text and hashes."""
    low = lower_ascii(raw)
    starts, ends, first = words(low, off, WORDS)
    return low, starts, ends, first, range_hash(prefix_hash(low), starts, ends)


class Windows:
    """The benchmark's windows by length: sorted hashes and, for each hash, its texts with their items."""

    def __init__(self, items: pa.Table, n: int):
        found: dict[int, dict[int, dict[bytes, set]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
        vocabulary = []
        for batch in items.to_batches():
            for rows, raw, off in slices(iter([batch]), "text"):
                low, starts, ends, first, hashes = normalised(raw, off)
                data = low.tobytes()
                vocabulary.append(np.unique(hashes))
                for k, item in enumerate(rows.column("item_id").to_pylist()):
                    a, b = int(first[k]), int(first[k + 1])
                    if a == b:
                        continue
                    size = min(n, b - a)
                    for at, key in enumerate(windows(hashes[a:b], size).tolist()):
                        at += a
                        text = b" ".join(data[s:e] for s, e in zip(starts[at : at + size], ends[at : at + size]))
                        found[size][key][text].add(item)
        self.vocabulary = np.unique(np.concatenate(vocabulary)) if vocabulary else np.zeros(0, np.uint64)
        self.by_size = {
            size: (np.sort(np.fromiter(keys, np.uint64, len(keys))), {k: dict(v) for k, v in keys.items()})
            for size, keys in found.items()
        }

    def hits(self, data: bytes, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, hashes: np.ndarray):
        """(first word, number of words, item ids) of every occurrence; ``first`` bounds the texts."""
        if not len(self.vocabulary) or not len(hashes):
            return
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = np.zeros(len(hashes) + 1, np.int64)
        np.cumsum(self.vocabulary[at] == hashes, out=known[1:])
        ends_text = np.repeat(first[1:], np.diff(first))  # where each word's text ends
        for size, (keys, texts) in self.by_size.items():
            if len(hashes) < size:
                continue
            place = np.arange(len(hashes) - size + 1)
            place = place[(known[size:] - known[:-size] == size) & (place + size <= ends_text[: len(place)])]
            if not len(place):
                continue
            run = place[:, None] + np.arange(size)
            keyed = _rows_hash(hashes[run], size)
            near = np.minimum(np.searchsorted(keys, keyed), len(keys) - 1)
            for k in np.flatnonzero(keys[near] == keyed).tolist():
                w = int(place[k])
                text = b" ".join(data[s:e] for s, e in zip(starts[w : w + size].tolist(), ends[w : w + size].tolist()))
                if (items := texts[int(keyed[k])].get(text)) is not None:
                    yield w, size, items


def _rows_hash(rows: np.ndarray, size: int) -> np.ndarray:
    """``windows`` of each row of ``size`` word hashes."""
    return windows(rows.ravel(), size)[::size] if len(rows) else np.zeros(0, np.uint64)


def mark(docs: DataFrame, items: DataFrame, n: int = WINDOW, keep: list[str] | None = None, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``row`` and MARKS: words, words inside an occurrence, items (sorted) and byte spans of the hits."""
    bench = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").cast("binary").alias("text"))
    size = bench.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    parts = max(1, -(-size // most_bytes))
    session = docs.sparkSession

    def scan(frame: DataFrame, part: int, columns: list[str] | None) -> DataFrame:
        some = bench if parts == 1 else bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        held = session.sparkContext.broadcast(Windows(some.toArrow(), n))

        def run(rows: pa.RecordBatch, raw: np.ndarray, off: np.ndarray) -> list:
            kept(None)
            low, starts, ends, first, hashes = normalised(raw, off)
            hit = np.zeros(len(starts) + 1, np.int64)  # +1 where an occurrence begins, -1 after it
            texts = len(off) - 1
            named: list[set] = [set() for _ in range(texts)]
            begun = np.zeros(len(starts) + 1, np.int64)
            for w, size, ids in held.value.hits(low.tobytes(), starts, ends, first, hashes):
                begun[w] += 1
                begun[w + size] -= 1
                named[int(np.searchsorted(first, w, "right")) - 1].update(ids)
            np.cumsum(begun, out=hit)
            inside = hit[:-1] > 0
            counts = [np.count_nonzero(inside[a:b]) for a, b in zip(first[:-1], first[1:])]
            spans: list[list] = [[] for _ in range(texts)]
            for k in np.flatnonzero(counts).tolist():
                a, b = int(first[k]), int(first[k + 1])
                edge = np.flatnonzero(np.diff(np.concatenate([[False], inside[a:b], [False]]).astype(np.int8)))
                spans[k] = [
                    {"start": int(starts[a + s] - off[k]), "end": int(ends[a + e - 1] - off[k])}
                    for s, e in zip(edge[::2], edge[1::2])
                ]
            listed = [sorted(x - {None}) for x in named]
            return [np.diff(first), counts, listed, spans]

        return annotate(frame, run, MARKS, columns)

    if parts == 1:
        return scan(docs, 0, keep)
    return _in_parts(docs, scan, parts, keep)


def _in_parts(docs: DataFrame, scan, parts: int, keep: list[str] | None) -> DataFrame:
    """One scan for each part of a large benchmark, its marks merged into those found so far."""
    columns = docs.columns if keep is None else keep
    row = F.struct(*[docs[f"`{c}`"] for c in columns])
    found = docs.select(
        row.alias("given"), docs["text"].alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast("array<string>").alias("items"), F.lit(None).cast("array<struct<start:long,end:long>>").alias("spans"),
    )
    for part in range(parts):
        marked = scan(found, part, None)
        spans = F.concat(F.coalesce("row.spans", F.array().cast("array<struct<start:long,end:long>>")), F.col("spans"))
        items = F.array_sort(F.array_union(F.coalesce("row.items", F.array().cast("array<string>")), F.col("items")))
        found = materialise(
            marked.select("row.given", "row.text", "n_words", items.alias("items"), merged(spans).alias("spans")), "marked"
        )
    hit = _words_inside(found)
    return hit.select(F.col("given").alias("row"), "n_words", "n_hit", "items", "spans")


def merged(spans):
    """Spans in order, those that overlap joined."""
    return F.aggregate(
        F.array_sort(spans),
        F.array().cast("array<struct<start:long,end:long>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )


def _words_inside(found: DataFrame) -> DataFrame:
    """n_hit: the words within the spans."""

    def run(rows: pa.RecordBatch, raw: np.ndarray, off: np.ndarray) -> list:
        _, starts, _, first, _ = normalised(raw, off)
        out = []
        for k, spans in enumerate(rows.column("row").field("spans").to_pylist()):
            own = starts[first[k] : first[k + 1]] - off[k]
            out.append(sum(int(np.searchsorted(own, x["end"]) - np.searchsorted(own, x["start"])) for x in spans or []))
        return [out]

    return annotate(found, run, "n_hit long").select("row.given", "row.n_words", "n_hit", "row.items", "row.spans")


def clean(docs: DataFrame, items: DataFrame, remove: str = "document", n: int = WINDOW) -> DataFrame:
    """The documents without contaminated ones, or with the hit spans cut out of their texts (``remove="span"``)."""
    marked = mark(docs, items, n)
    if remove == "document":
        return marked.filter("n_hit = 0").select("row.*")
    if remove != "span":
        raise ValueError("remove is document or span")
    raw = F.col("row.text").cast("string").cast("binary")
    # what stands before each span, then what follows the last
    before = F.transform(
        F.col("spans"),
        lambda x, i: F.substring(raw, _int(F.when(i == 0, F.lit(1)).otherwise(F.col("spans")[i - 1]["end"] + 1)),
                                 _int(x["start"] - F.when(i == 0, F.lit(0)).otherwise(F.col("spans")[i - 1]["end"]))),
    )
    last = F.element_at("spans", -1)["end"]
    rest = F.substring(raw, _int(last + 1), _int(F.length(raw) - last))
    joined = F.aggregate(before, F.lit(b""), lambda done, x: F.concat(done, x))
    text = F.when(F.size("spans") == 0, F.col("row.text")).otherwise(F.decode(F.concat(joined, rest), "UTF-8"))
    columns = [text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]
    return marked.select(*columns)


def _int(column):
    return column.cast("int")
