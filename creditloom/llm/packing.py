"""Tokenised documents packed into sequences by bounded-space online best-fit.

``tokenise`` encodes whole texts and cuts what is longer than a sequence; ``pack`` places the
pieces.  Each task keeps a fixed number of open bins.  A bitset has a bit for every amount of free
space that some open bin has, so the tightest fitting bin is one shift and one lowest-bit test away.
When all bins are open and none fits, the fullest closes.  Bins still open when a task ends are
not closed half empty: they go on, as items, to a round of fewer tasks, until one task is left.

Only lengths travel between tasks, never tokens.  Pieces are dealt out and ordered by a hash, so a
lost task is redone the same way.

Edge cases: a null or empty text is one piece holding the end id alone; repeated rows are packed
once each; an empty table gives no rows; other columns are ignored, whatever their names.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from creditloom.llm.text import SPACES, WordIds, kept, lower_ascii, prefix_hash, range_hash, slices, word_table, words
from creditloom.sources.tables import materialise

OPEN_BINS = 512
ROWS_PER_TASK = 200_000
HAND_ON = 64

_INSIDE = word_table(SPACES)
# A letter and another ASCII sign never share a token.  The apostrophe and non-ASCII bytes stay
# with their neighbours, which only the tokenizer itself can tell apart.
_CUT = np.zeros(256, np.uint8)
_CUT[[c for c in range(0x80) if c not in SPACES and c != 0x27]] = 2
_CUT[[*range(97, 123), *range(65, 91)]] = 1
_CUT[0x27] = 8
_CUT[0x80:] = 8
_CUT[list(SPACES)] = 16


def _tokenizer(path: str):
    """The tokenizer, its table of words and the spelling of its special tokens."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ends = np.zeros(max(tokenizer.get_vocab().values()) + 1, bool)
    ends[[i for token, i in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def encode(found: list[bytes]) -> list[np.ndarray]:
        """Single tokens of the pre-tokenizer go together; the mark of a word's end parts them."""
        texts = [w.decode("utf-8", "replace") for w in found]
        plain = [i for i, w in enumerate(texts) if w.isalpha()]
        out: list = [None] * len(found)
        for k in range(0, len(plain), 500):
            some = plain[k : k + 500]
            ids = np.array(tokenizer.encode(" ".join([texts[i] for i in some]), add_special_tokens=False).ids, np.int32)
            parts = np.flatnonzero(ends[ids])
            if len(parts) == len(some):  # else lower case has made a word into several tokens
                for i, s, e in zip(some, [0, *(parts[:-1] + 1).tolist()], (parts + 1).tolist()):
                    out[i] = ids[s:e]
        rest = [i for i, w in enumerate(out) if w is None]
        for i, e in zip(rest, tokenizer.encode_batch([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    special = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
    return tokenizer, WordIds(encode), special


def _piece_schema(key: pa.DataType, with_ids: bool) -> pa.Schema:
    fields = [("doc_id", key), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    return pa.schema([*fields, ("ids", pa.list_(pa.int32()))] if with_ids else fields)


def tokenise(docs: DataFrame, tokenizer: str, end_id: int = 1, longest: int = 4096, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``longest`` ids: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A text's ids are those of the tokenizer over the whole text, then ``end_id``.  Texts are
    encoded part by part between white space, where no token of a tokenizer that drops white space
    can run on; each distinct part once.  Texts that spell out a special token are encoded whole.
    """
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    narrow = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    key = to_arrow_type(narrow.schema["doc_id"].dataType)
    schema = _piece_schema(key, with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        whole, table, special = kept(("packing", tokenizer), lambda: _tokenizer(tokenizer))
        for rows, raw, off in slices(batches, "text"):
            low = lower_ascii(raw)
            starts, ends, first = words(low, off, _INSIDE, _CUT)
            flat, bounds = table.ids(low, starts, ends, range_hash(prefix_hash(low), starts, ends))
            cuts, data = bounds[first], raw.tobytes()
            spelt = any(s in data for s in special)
            doc_ids, out = rows.column("doc_id").to_pylist(), [[] for _ in schema]
            for k, doc in enumerate(doc_ids):
                ids = flat[cuts[k] : cuts[k + 1]]
                if spelt and any(s in (text := data[off[k] : off[k + 1]]) for s in special):
                    ids = whole.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
                ids = np.append(np.asarray(ids, np.int32), np.int32(end_id))
                for piece, start in enumerate(range(0, len(ids), longest)):
                    part = ids[start : start + longest]
                    row = [doc, piece, start, len(part), zlib.crc32(part.astype("<u4").tobytes()), part]
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.record_batch([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)

    ddl = f"doc_id {dict(narrow.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return narrow.mapInArrow(run, ddl)


class OpenBins:
    """A fixed number of open bins by free space; ``place`` returns the item's bin and offset."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free space
        self.bits = 0  # bit f: an open bin has f free
        self.open = self.made = 0

    def _take(self, space: int) -> int:
        found = self.free[space].pop()
        if not self.free[space]:
            self.bits ^= 1 << space
        self.open -= 1
        return found

    def place(self, size: int) -> tuple[int, int]:
        fitting = self.bits >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            found = self._take(space)
        else:
            if self.open >= self.most:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
            found, space = self.made, self.capacity
            self.made += 1
        if space > size:
            self.free[space - size].append(found)
            self.bits |= 1 << (space - size)
            self.open += 1
        return found, self.capacity - space

    def left(self) -> dict[int, int]:
        """Tokens in each bin that is still open."""
        return {b: self.capacity - space for space, found in enumerate(self.free) for b in found}


def _round(items: DataFrame, tasks: int, number: int, capacity: int, most: int) -> DataFrame:
    """Items (item, length, rank) placed by ``tasks`` tasks: item, bin, base, open (tokens in its bin if still open)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bins, placed, task = OpenBins(capacity, most), [], TaskContext.get().partitionId()
        for batch in batches:
            found = [bins.place(n) for n in batch.column("length").to_pylist()]
            placed.append((batch.column("item"), found))
        left = bins.left()
        for item, found in placed:
            yield pa.record_batch(
                {
                    "item": item,
                    "bin": pa.array([(number << 56) | (task << 32) | b for b, _ in found], pa.int64()),
                    "base": pa.array([o for _, o in found], pa.int64()),
                    "open": pa.array([left.get(b) for b, _ in found], pa.int64()),
                }
            )

    dealt = items.repartition(tasks, "rank").sortWithinPartitions("rank", "item")
    return dealt.select("item", "length").mapInArrow(run, "item long, bin long, base long, open long")


def pack(pieces: DataFrame, capacity: int = 4096, open_bins: int = OPEN_BINS) -> DataFrame:
    """``pieces`` (with a ``length`` of at most ``capacity``) with sequence_id and offset."""
    if {"item", "rank", "bin", "base", "open"} & set(pieces.columns):
        raise ValueError("item, rank, bin, base and open are used for the packing itself")
    # numbers given while writing, so that later reads agree on them
    numbered = materialise(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    items = numbered.select("item", "length", F.xxhash64("item").alias("rank"))
    count = numbered.count()
    tasks = max(1, -(-count // ROWS_PER_TASK))
    placed = materialise(_round(items, tasks, 0, capacity, open_bins), "packed")
    result = placed.select("item", "bin", "base")
    number = 0
    while tasks > 1:
        number += 1
        tasks = -(-tasks // HAND_ON)
        left = placed.filter("open is not null").groupBy(F.col("bin").alias("item")).agg(F.max("open").alias("length"))
        placed = materialise(_round(left.withColumn("rank", F.xxhash64("item")), tasks, number, capacity, open_bins), "packed")
        moved = placed.select(F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("base").alias("shift"))
        result = result.join(moved, "bin", "left").select(
            "item", F.coalesce("to", "bin").alias("bin"), (F.col("base") + F.coalesce("shift", F.lit(0))).alias("base")
        )
    return (
        numbered.join(result, "item").drop("item")
        .withColumnRenamed("bin", "sequence_id").withColumnRenamed("base", "offset")
    )
