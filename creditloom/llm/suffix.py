"""Exact repeats of long byte strings, by column-wise construction over many documents.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else as well, in the same
document or another.  Copies stay nowhere: every occurrence goes, the first included.

Equal strings meet, wherever they are, by an anchor: of the ``WIDTH`` grams inside a window of
``length`` bytes, the one with the least hash.  It depends on the window's bytes alone.  Windows in a
row that share an anchor are one string of the collection (length + WIDTH - 1 bytes at most); only
strings whose anchor occurs twice or more are fetched, and equal strings are one, with a weight.

Strings of one anchor form a small multi-document collection whose suffix order is built column by
column, from the right end to the left: each round inserts one symbol per string, a stable sort by
that symbol gives the new order (the last-to-first step of the Burrows-Wheeler transform, whose
column is the inserted symbols in the order before), and common prefixes follow from range minima.
Because the anchor lines the strings up, equal windows start in equal columns: a symbol counts as
(column, byte), so each round's part of the transform is a block of its own and no earlier block is
rewritten.  The anchor itself is one symbol, as long as its gram.  Columns of symbols and of marks
lie in files, written and read one column after another, so memory holds the order and the common
prefixes only.  Where neighbours share ``length`` bytes in a column, both windows are repeats.

A second, larger bound (``longer``) is read off the same order: strings then go on to the right by
the difference.  Equal strings of ``longer`` bytes begin with equal windows of ``length`` bytes, so
they share anchor, group and column, and neighbours there share ``longer`` bytes.

Anchors with very many different strings (a passage that a third of all documents quote, each in
other words around it) are not one task's work: their windows are cut into narrower ranges, each
with a longer shared gram, until groups are small; a range of one window is an equality of hashes.

Edge cases: null texts are empty; texts under ``length`` bytes lose nothing; repeated rows are
repeats of each other; rows without doc_id count like others; an empty table gives no rows; other
columns ride along in ``row``, whatever they are called.  Texts, grams and
strings are known by 64-bit hashes when they are counted; inside a collection bytes are compared.
"""

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.text import annotate, kept, mix, prefix_hash, slices
from creditloom.operators.joins import many_to_one
from creditloom.sources.tables import Kept, materialise

LENGTH = 400
PASSAGE = 240  # bytes of a passage of over 50 words: below those of 50 words of 3.8 letters
WIDTH = 300  # windows that may share an anchor, at most; the anchor's gram has length - width + 1 bytes
LEAST_GRAM = 16
NARROWER = 7  # a crowded anchor's windows are cut into so many ranges
CROWD = 20_000  # different strings that one task may order together
STRINGS_PER_BUCKET = 10_000
BLOCK = 1 << 20

def width_of(length: int) -> int:
    """How many windows of ``length`` bytes may share an anchor."""
    return max(1, min(WIDTH, length * 3 // 4, length - LEAST_GRAM + 1))


SPANS = "array<struct<start:long,end:long>>"


def anchors(raw: np.ndarray, off: np.ndarray, length: int, width: int):
    """(text, anchor, first window, last window, gram hash) of each run of windows with one anchor.

    Positions are relative to the text.
    """
    gram = length - width + 1
    out = []
    for begin in range(0, len(raw) - length + 1, BLOCK):
        part = raw[begin : begin + BLOCK + length - 1]
        prefix = prefix_hash(part)
        grams = prefix[gram:] - prefix[:-gram]
        grams *= _down(len(part))[: len(grams)]
        grams = mix(grams)
        # least hash first, then leftmost: the place takes the low bits
        keys = (grams & ~np.uint64((1 << 22) - 1)) | np.arange(len(grams), dtype=np.uint64)
        rest = -len(keys) % width
        tiles = np.append(keys, np.full(rest, np.iinfo(np.uint64).max)).reshape(-1, width)
        after = np.minimum.accumulate(tiles, axis=1).ravel()
        before = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
        count = len(part) - length + 1
        least = np.minimum(before[:count], after[width - 1 : width - 1 + count])
        at = (least & np.uint64((1 << 22) - 1)).astype(np.int64)
        window = np.arange(count) + begin
        text = np.searchsorted(off, window, "right") - 1
        fits = np.flatnonzero(window + length <= off[text + 1])
        if not len(fits):
            continue
        change = np.flatnonzero((np.diff(fits) > 1) | (np.diff(at[fits]) != 0) | (np.diff(text[fits]) != 0)) + 1
        first, last = fits[np.append(0, change)], fits[np.append(change - 1, len(fits) - 1)]
        base = off[text[first]]
        out.append((text[first], at[first] + begin - base, first + begin - base, last + begin - base, grams[at[first]].astype(np.int64)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    text, at, first, last, h = (np.concatenate(x) for x in zip(*out))
    # a run that a block's end parts is one: no window may lie in two strings of one anchor
    begins = np.flatnonzero(np.append(True, (np.diff(text) != 0) | (np.diff(at) != 0) | (first[1:] != last[:-1] + 1)))
    ends = np.append(begins[1:], len(text)) - 1
    return text[begins], at[begins], first[begins], last[ends], h[begins]


def _down(n: int) -> np.ndarray:
    from creditloom.llm.text import _powers

    return _powers(n)[1]


def _key(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=8).digest(), "little", signed=True)


def _anchored(texts: DataFrame, length: int, width: int) -> DataFrame:
    """(h, tkey, m, lo, hi) of all texts (tkey, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(None)
        for rows, raw, off in slices(batches, "text"):
            text, m, lo, hi, h = anchors(raw, off, length, width)
            tkey = rows.column("tkey").to_numpy()
            yield pa.record_batch({"h": h, "tkey": tkey[text], "m": m, "lo": lo, "hi": hi})

    return texts.mapInArrow(run, "h long, tkey long, m long, lo long, hi long")


def _strings(texts: DataFrame, wanted: DataFrame, reach: int) -> DataFrame:
    """Each wanted run's string, up to ``reach`` bytes from its last window's start: (h, skey, at, tkey, m, lo, hi, times, bytes).

    Bytes come once for each skey and task.
    """
    entry = F.struct("h", "m", "lo", "hi", "times")
    lists = wanted.groupBy("tkey").agg(F.collect_list(entry).alias("runs"))
    joined = many_to_one(texts, lists, ["tkey"])  # one text may have very many copies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts_seen: set[int] = set()
        seen: set[int] = set()
        for rows, raw, off in slices(batches, "text"):
            out: list[list] = [[] for _ in range(9)]
            data = raw.tobytes()
            keys, runs = rows.column("tkey").to_pylist(), rows.column("runs").to_pylist()
            for k, (tkey, entries) in enumerate(zip(keys, runs)):
                if tkey in texts_seen:
                    continue
                if len(texts_seen) < 1_000_000:
                    texts_seen.add(tkey)
                base, end = int(off[k]), int(off[k + 1])
                for x in entries:
                    at = x["m"] - x["lo"]
                    string = data[base + x["lo"] : min(base + x["hi"] + reach, end)]
                    skey = _key(at.to_bytes(4, "little"), (x["m"] - x["hi"]).to_bytes(4, "little"), string)
                    fresh = skey not in seen
                    if len(seen) < 1_000_000:
                        seen.add(skey)
                    row = (x["h"], skey, at, tkey, x["m"], x["lo"], x["hi"], x["times"], string if fresh else None)
                    for column, value in zip(out, row):
                        column.append(value)
            types = [pa.int64()] * 8 + [pa.binary()]
            names = ["h", "skey", "at", "tkey", "m", "lo", "hi", "times", "bytes"]
            yield pa.record_batch([pa.array(v, t) for v, t in zip(out, types)], names=names)

    ddl = "h long, skey long, at long, tkey long, m long, lo long, hi long, times long, bytes binary"
    return joined.mapInArrow(run, ddl)


class Columns:
    """Rows of strings laid out by column in a file: written by blocks of rows, read one column at a time."""

    def __init__(self, columns: int, rows: int, kind=np.uint16):
        self.file = tempfile.TemporaryFile(dir=os.environ.get("TMPDIR"))
        self.data = np.memmap(self.file, kind, "w+", shape=(columns, rows))

    def close(self) -> None:
        del self.data
        self.file.close()


def insert(order: np.ndarray, common: np.ndarray, group: np.ndarray, symbols: np.ndarray):
    """One round: the order of all strings' suffixes after one more symbol on the left, and common prefixes.

    ``common[i]``: symbols that the suffixes at i - 1 and i share, -1 between groups.
    """
    now = symbols[order]
    keys = group[order] * 512 + now
    if (keys[1:] >= keys[:-1]).all():
        same = np.zeros(len(keys), bool)
        same[1:] = keys[1:] == keys[:-1]
        return order, np.where(same, common + 1, np.minimum(common, 0))
    step = np.argsort(keys, kind="stable")
    keys = keys[step]
    same = np.zeros(len(keys), bool)
    same[1:] = keys[1:] == keys[:-1]
    grown = np.zeros(len(keys), common.dtype)
    new_group = group[order][step]
    grown[0] = -1
    grown[1:][new_group[1:] != new_group[:-1]] = -1
    where = np.flatnonzero(same)
    if len(where):
        low, high = step[where - 1] + 1, step[where] + 1
        bounds = np.empty(2 * len(where), np.int64)
        bounds[0::2], bounds[1::2] = low, high
        grown[where] = np.minimum.reduceat(np.append(common, 0), bounds)[0::2] + 1
    return order[step], grown


def repeats_in(
    strings: list[bytes], at: np.ndarray, near: np.ndarray, groups: np.ndarray, weight: np.ndarray, length: int, width: int, longer: int | None = None
) -> list[list[list[tuple[int, int]]]]:
    """Of each bound and string, the ranges (first, last) of distances before its anchor where a repeated window starts.

    The bounds are ``length`` and, if given, ``longer``.  Strings of one group share the gram at their
    anchor; ``at`` is the anchor's place in the string, ``near`` its distance from the last window.
    """
    bounds = [length] if longer is None else [length, longer]
    gram, n, side, right = length - width + 1, len(strings), width - 1, bounds[-1] - (length - width + 1)
    sizes = np.fromiter(map(len, strings), np.int64, n)
    far = at.astype(np.int64)  # distances of the first window and, for each bound, of the last that fits
    nears = [np.maximum(near, far + bound - sizes) for bound in bounds]
    text = Columns(side + 1 + right, n)  # columns left to right; 0 is beyond a string's end
    cores: dict[tuple[int, bytes], int] = {}
    group = np.zeros(n, np.int64)
    for begin in range(0, n, 1000):
        block = np.zeros((min(1000, n - begin), side + 1 + right), np.uint16)
        for r, (string, a) in enumerate(zip(strings[begin : begin + 1000], at[begin : begin + 1000].tolist())):
            group[begin + r] = cores.setdefault((int(groups[begin + r]), string[a : a + gram]), len(cores))
            symbols = np.frombuffer(string, np.uint8).astype(np.uint16) + 1
            block[r, side - a : side] = symbols[:a]
            rest = symbols[a + gram :]
            block[r, side + 1 : side + 1 + len(rest)] = rest
        text.data[:, begin : begin + len(block)] = block.T
    marks = Columns(width, n, np.uint8)  # a bit for each bound
    order = np.argsort(group, kind="stable")
    ordered = group[order]
    common = np.where(np.append(True, ordered[1:] != ordered[:-1]), -1, 0).astype(np.int32)
    often = weight > 1
    for column in range(side + right, side, -1):  # right of the anchor
        order, common = insert(order, common, group, text.data[column])
    common = np.where(common >= 0, common + gram, common)  # the anchor, equal within a group
    for distance in range(width):
        if distance:
            order, common = insert(order, common, group, text.data[side - distance])
        bits = np.zeros(n, np.uint8)
        for bit, (bound, last) in enumerate(zip(bounds, nears)):
            twin = common >= bound
            mark = np.zeros(n, bool)
            mark[order[twin]] = True
            mark[order[:-1][twin[1:]]] = True
            bits |= ((mark | often) & (last <= distance) & (distance <= far)).astype(np.uint8) << bit
        marks.data[distance] = bits
    out: list[list[list[tuple[int, int]]]] = [[] for _ in bounds]
    for begin in range(0, n, 1000):
        block = np.asarray(marks.data[:, begin : begin + 1000]).T
        for bit, found in enumerate(out):
            edged = np.diff(np.pad((block >> bit & 1).astype(np.int8), ((0, 0), (1, 1))), axis=1)
            for row in edged:
                edge = np.flatnonzero(row)
                found.append([(int(s), int(e) - 1) for s, e in zip(edge[::2], edge[1::2])])
    text.close()
    marks.close()
    return out


RANGES = "array<struct<near:int,far:int>>"


def _ordered(strings: DataFrame, length: int, width: int, buckets: int, longer: int | None) -> DataFrame:
    """(h, skey, bound, ranges) of the strings that hold a repeat; whole groups (h) are together in a bucket."""

    def run(bucket: pa.Table) -> pa.Table:
        columns = [bucket.column(c).to_numpy() for c in ("at", "near", "h", "weight")]
        bounds = repeats_in(bucket.column("bytes").to_pylist(), *columns, length, width, longer)
        kind = pa.list_(pa.struct([("near", pa.int32()), ("far", pa.int32())]))
        out = []
        for bound, found in zip((length, longer), bounds):
            some = [i for i, x in enumerate(found) if x]
            ranges = pa.array([[{"near": s, "far": e} for s, e in found[i]] for i in some], kind)
            marked = bucket.select(["h", "skey"]).take(pa.array(some, pa.int64()))
            out.append(marked.append_column("bound", pa.array([bound] * len(some), pa.int32())).append_column("ranges", ranges))
        return pa.concat_tables(out)

    dealt = strings.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))
    return dealt.select("bucket", "h", "skey", "at", "near", "weight", "bytes").groupBy("bucket").applyInArrow(
        run, f"h long, skey long, bound int, ranges {RANGES}"
    )


def _pieces(crowded: DataFrame, length: int, width: int, narrow: int) -> DataFrame:
    """Strings of crowded anchors cut into ranges of ``narrow`` windows: (h, skey, shift, weight, piece_h, piece_skey, at, near, bytes)."""
    gram = length - narrow + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for h, skey, at, least, weight, string in zip(*(batch.column(c).to_pylist() for c in ("h", "skey", "at", "near", "weight", "bytes"))):
                last = max(least, at + length - len(string))
                for shift in range(0, width, narrow):
                    near, far = max(shift, last), min(shift + narrow - 1, at)
                    if near > far:
                        continue
                    piece = string[at - far : at - near + length]
                    place = far - shift
                    core = piece[place : place + gram]
                    row = (h, skey, shift, weight, _key(core), _key(place.to_bytes(4, "little"), piece), place, near - shift, piece)
                    for column, value in zip(out, row):
                        column.append(value)
            names = ["h", "skey", "shift", "weight", "piece_h", "piece_skey", "at", "near", "bytes"]
            yield pa.record_batch([pa.array(v, pa.binary() if c == "bytes" else pa.int64()) for v, c in zip(out, names)], names=names)

    ddl = "h long, skey long, shift long, weight long, piece_h long, piece_skey long, at long, near long, bytes binary"
    return crowded.select("h", "skey", "at", "near", "weight", "bytes").mapInArrow(run, ddl)


def _narrowed(crowded: DataFrame, length: int, width: int, crowd: int) -> DataFrame:
    """(h, skey, bound, ranges) of strings of crowded anchors, by narrower ranges of their windows of ``length`` bytes."""
    narrow = -(-width // NARROWER)
    pieces = materialise(_pieces(crowded, length, width, narrow), "pieces")
    below = pieces.select(F.col("piece_h").alias("h"), F.col("piece_skey").alias("skey"), "at", "near", "weight", "bytes")
    below = below.groupBy("h", "skey").agg(*[F.first(c).alias(c) for c in ("at", "near", "bytes")], F.sum("weight").alias("weight"))
    deeper = repeats(below, length, narrow, crowd if narrow > 1 else 1 << 62)
    deeper = deeper.select(F.col("h").alias("piece_h"), F.col("skey").alias("piece_skey"), "bound", "ranges")
    back = pieces.select("h", "skey", "shift", "piece_h", "piece_skey").join(deeper, ["piece_h", "piece_skey"])
    moved = F.transform(
        "ranges", lambda r: F.struct((r["near"] + F.col("shift")).cast("int").alias("near"), (r["far"] + F.col("shift")).cast("int").alias("far"))
    )
    moved = back.select("h", "skey", "bound", moved.alias("ranges"))
    return moved.groupBy("h", "skey", "bound").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def repeats(strings: DataFrame, length: int, width: int, crowd: int = CROWD, longer: int | None = None) -> DataFrame:
    """(h, skey, bound, ranges) of weighted strings (h, skey, at, near, weight, bytes), each skey once.

    ``bound`` is ``length`` or ``longer``.
    """
    sizes = strings.groupBy("h").agg(F.count("*").alias("members"), F.sum("weight").alias("total")).filter("total > 1")
    met = materialise(many_to_one(strings, sizes, ["h"]), "met", "zstd")
    size = met.agg(F.sum(F.when(F.col("members") <= crowd, 1)), F.max("members")).first()
    buckets = max(1, -(-(size[0] or 0) // STRINGS_PER_BUCKET))
    found = _ordered(met.filter(F.col("members") <= crowd), length, width, buckets, longer)
    if (size[1] or 0) <= crowd:
        return found
    # a bound at a time: what the larger one adds to the right would keep the ranges of the smaller crowded
    for bound in [length] if longer is None else [length, longer]:
        found = found.unionByName(_narrowed(met.filter(F.col("members") > crowd), bound, width, crowd))
    return found


def spans(docs: DataFrame, length: int = LENGTH, width: int | None = None, crowd: int = CROWD, longer: int | None = None) -> DataFrame:
    """(tkey, spans): byte ranges of repeats in each different text that has any; tkey is xxhash64 of the text.

    With ``longer``, a larger bound, also long_spans: those of its repeats, null where there are none.
    """
    width = width_of(length) if width is None else width
    reach = length if longer is None else longer
    texts = docs.select(F.xxhash64("text").alias("tkey"), F.col("text").cast("string").cast("binary").alias("text"))
    texts = texts.filter(F.length("text") >= length)
    store = Kept(docs.sparkSession, "anchors")
    runs = store.replace(_anchored(texts, length, width))
    again = runs.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    # counted first, so that the join, which one anchor may crowd, has exchanges of its own
    counted = runs.groupBy("h", "tkey", "m", "lo", "hi").agg(F.count("*").alias("times"))
    wanted = many_to_one(counted, again.withColumn("again", F.lit(True)), ["h"]).drop("again")
    cut = materialise(_strings(texts, wanted, reach), "strings", "zstd")
    store.drop()  # whatever follows reads the strings
    held = cut.select("h", "skey", "tkey", "m", "lo", "hi", "times").distinct()
    weights = held.groupBy("h", "skey").agg(F.sum("times").alias("weight"))
    bodies = cut.filter("bytes is not null").withColumn("near", F.col("m") - F.col("hi"))
    bodies = bodies.groupBy("h", "skey").agg(*[F.first(c).alias(c) for c in ("at", "near", "bytes")])
    found = repeats(bodies.join(weights, ["h", "skey"]), length, width, crowd, longer)
    hits = held.join(found, ["h", "skey"]).select("tkey", "bound", F.transform(
        "ranges", lambda r: F.struct((F.col("m") - r["far"]).alias("start"), (F.col("m") - r["near"] + F.col("bound")).alias("end"))
    ).alias("spans"))
    gathered = lambda bound: F.flatten(F.collect_list(F.when(F.col("bound") == bound, F.col("spans"))))
    columns = [gathered(length).alias("spans")] + ([] if longer is None else [gathered(longer).alias("long_spans")])
    return hits.groupBy("tkey").agg(*columns)


CUT = f"n_bytes long, n_removed long, removed {SPANS}, kept binary"
QUOTED = f"n_passage long, passages {SPANS}"


def _merged(found: list | None) -> list[list[int]]:
    """Maximal runs of byte ranges."""
    runs: list[list[int]] = []
    for x in sorted((x["start"], x["end"]) for x in found or []):
        if runs and x[0] <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], x[1])
        else:
            runs.append(list(x))
    return runs


def removed(
    docs: DataFrame, length: int = LENGTH, keep: list[str] | None = None, with_text: bool = False, passage: int | None = None
) -> DataFrame:
    """``row``, n_bytes, n_removed, removed (the maximal runs of bytes that go) and kept (the bytes that stay).

    With ``with_text``, instead of kept: new_text, the text of what stays where something goes, else null.
    With ``passage``, a bound below ``length``, also n_passage and passages: bytes and maximal runs that
    strings of so many bytes cover which start elsewhere too; they stay.
    """
    columns = docs.columns if keep is None else keep
    row = F.struct(*[docs[f"`{c}`"] for c in columns])
    keyed = docs.select(row.alias("row"), docs["text"].alias("text"), F.xxhash64(docs["text"]).alias("tkey"))
    if passage is None:
        found = spans(docs.select("text"), length)
    else:
        found = spans(docs.select("text"), passage, longer=length).select("tkey", F.col("long_spans").alias("spans"), F.col("spans").alias("passages"))
    marks = [c for c in found.columns if c != "tkey"]
    joined = many_to_one(keyed, found, ["tkey"], "left").select("row", "text", *marks)
    listed = lambda runs: [{"start": s, "end": e} for s, e in runs]

    def run(rows: pa.RecordBatch, raw: np.ndarray, off: np.ndarray) -> list:
        data, lists = raw.tobytes(), [rows.column("row").field(c) for c in marks]
        out: list[list] = [[] for _ in range(4 if passage is None else 6)]
        for k in range(len(rows)):
            text = data[off[k] : off[k + 1]]
            runs, *quoted = [_merged(own[k].as_py()) for own in lists]
            edges = [0, *(b for r in runs for b in r), len(text)]
            left = b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2]))
            last = left if not with_text else left.decode("utf-8", "ignore") if runs else None
            more = [x for q in quoted for x in (sum(e - s for s, e in q), listed(q))]
            for column, value in zip(out, [len(text), len(text) - len(left), listed(runs), last, *more]):
                column.append(value)
        return out

    columns = CUT.replace("kept binary", "new_text string") if with_text else CUT
    columns = columns if passage is None else f"{columns}, {QUOTED}"
    cut = annotate(joined, run, columns, keep=["row", *marks])
    return cut.select("row.row", *[c for c in cut.columns if c != "row"])


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeats cut out of text; n_chars, where there is one, is the new text's.

    A character of which a cut leaves only some bytes goes too.  Texts without repeats, null
    included, stay as they are.
    """
    # one Python step for both the cut and its text: two in a row would hold twice the workers
    decoded = removed(docs, length, with_text=True)
    new = {"text": F.when(F.col("n_removed") > 0, F.col("new_text")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        count = F.length("new_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("n_removed") > 0, count).otherwise(F.col("row.n_chars"))
    return decoded.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
