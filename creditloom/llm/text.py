"""Vectorised words, windows and word tables over Arrow batches of whole texts.

Texts are handled as UTF-8 bytes in slices of bounded size, so a task's memory follows the slice
(or its longest single text), not its partition.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1_000_000
SPACES = bytes([0x20, *range(0x09, 0x0E)])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_SYMBOLS = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}
_KEPT: dict[tuple, object] = {}


def kept(key: tuple | None, make: Callable | None = None):
    """What a worker keeps from task to task: the thing made for ``key``, and nothing made for another."""
    others = [k for k in _KEPT if k != key]
    for other in others:
        del _KEPT[other]
    if others:
        pa.default_memory_pool().release_unused()
    if key is not None and key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT.get(key)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, 0 to n."""
    if len(_POWERS.get("up", ())) <= n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][: n + 1], _POWERS["down"][: n + 1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running polynomial hash, from which ``range_hash`` takes that of any range."""
    up, _ = _powers(len(buf))
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_SYMBOLS[buf] * up[: len(buf)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes from each start up to its end; equal bytes, equal hash."""
    _, down = _powers(len(prefix) - 1)
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a binary or string column; null counts as empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = pc.fill_null(column, b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, their bytes, their offsets): runs of rows of about SLICE_BYTES, no row cut."""
    for batch in batches:
        raw, off = as_bytes(batch.column(column))
        at, n = 0, batch.num_rows
        while at < n:
            to = max(at + 1, int(np.searchsorted(off, off[at] + SLICE_BYTES, "right")) - 1)
            to = min(to, n)
            yield batch.slice(at, to - at), raw[off[at] : off[to]], off[at : to + 1] - off[at]
            at = to


def word_table(separators: bytes) -> np.ndarray:
    """Which bytes belong to words."""
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    return inside


#: Words are runs of anything but ASCII white space.
BLANK_SEPARATED = word_table(SPACES)


def words(raw: np.ndarray, off: np.ndarray, inside: np.ndarray, cut: np.ndarray | None = None):
    """Starts, ends and each text's first word (one more at the end); no word crosses two texts.

    ``cut``: a class for each byte; neighbours whose classes add up to 3 are parted.
    """
    n = len(raw)
    part = np.zeros(n + 1, bool)  # a word may not run on into this byte
    part[off] = True
    if cut is not None and n > 1:
        kind = cut[raw]
        part[1:n] |= (kind[1:] + kind[:-1]) == 3
    within = np.zeros(n + 2, bool)
    within[1 : n + 1] = inside[raw]
    starts = np.flatnonzero(within[1 : n + 1] & (~within[:n] | part[:n]))
    ends = np.flatnonzero(within[1 : n + 1] & (~within[2 : n + 2] | part[1 : n + 1])) + 1
    return starts, ends, np.searchsorted(starts, off)


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A to Z as a to z; other bytes as they are."""
    return raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)


_STEPS = np.random.default_rng(77).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    count = len(hashes) - n + 1
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out += hashes[k : k + count] * _STEPS[k]
    return mix(out)


def whole(hashes: np.ndarray) -> np.ndarray:
    """Hash of the whole word sequence, as one item; differs from that of any window."""
    up, _ = _powers(len(hashes))
    return mix(np.array([np.sum(hashes * up[: len(hashes)]) + np.uint64(len(hashes) + 1)], np.uint64))


class WordIds:
    """Token ids of words, each distinct word encoded once; starts afresh beyond ``most`` words.

    ``encode`` takes a list of words and returns a list of id lists.
    """

    def __init__(self, encode: Callable[[list[bytes]], list], most: int = 600_000):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0

    def _add(self, keys: np.ndarray, found: list) -> None:
        length = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.concatenate([np.asarray(x, np.int32) for x in found]) if len(found) else np.zeros(0, np.int32)
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(len(flat), self.used) + len(flat), np.int32)])
        self.pool[self.used : self.used + len(flat)] = flat
        begin = self.used + np.cumsum(length) - length
        self.used += len(flat)
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.begin = np.insert(self.begin, at, begin[order])
        self.length = np.insert(self.length, at, length[order])

    def ids(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
        """All words' ids one after another, and where each word's begin (one more at the end)."""
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.most:
            self._clear()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        near = at < len(self.keys)
        new[near] = self.keys[at[near]] != keys[near]
        if new.any():
            data, pick = raw.tobytes(), first[new]
            self._add(keys[new], self.encode([data[s:e] for s, e in zip(starts[pick].tolist(), ends[pick].tolist())]))
            at = np.searchsorted(self.keys, keys)
        begin, length = self.begin[at][inverse], self.length[at][inverse]
        bounds = np.zeros(len(length) + 1, np.int64)
        np.cumsum(length, out=bounds[1:])
        flat = self.pool[np.repeat(begin - bounds[:-1], length) + np.arange(bounds[-1])]
        return flat, bounds


def annotate(docs, measure: Callable, columns: str, keep: list[str] | None = None, text: str = "text"):
    """One output row for each row of ``docs``: its columns as the struct ``row``, then ``columns`` (DDL).

    ``measure(rows, raw, off)`` returns a value array for each of ``columns``, a slice at a time.
    The struct keeps names of the input from clashing with the new ones.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    row = F.struct(*[docs[f"`{c}`"] for c in (docs.columns if keep is None else keep)])
    narrow = docs.select(row.alias("row"), docs[text].cast("string").cast("binary").alias("text"))
    added = _parse_datatype_string(columns)
    schema = StructType([StructField("row", narrow.schema["row"].dataType, False), *added.fields])
    types = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in slices(batches, "text"):
            found = measure(rows, raw, off)
            arrays = [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(found, types, strict=True)]
            yield pa.record_batch([rows.column("row"), *arrays], names=["row", *types.names])

    return narrow.mapInArrow(run, schema)


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of set flags between each two bounds."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
