"""Language identification by a string kernel.

A block of text is the set of its one-, two- and three-grams over letters (a blended spectrum,
presence only).  The kernel of two blocks is the number of n-grams they share over the geometric
mean of their set sizes, over the n-grams that some landmark has.  Landmarks drawn from the
labelled rows give Nyström features; one-versus-rest ridge regression on those gives one weight
vector per language.  Scoring is matrix products over batches of blocks: presence x landmarks, then
x weights.  Whole texts count: a text is cut into blocks, and its margins are their mean by letters.

Fitting takes a bounded sample: ``FIT_BLOCKS`` blocks in all, shared evenly among the languages (at
least 20 each), chosen by hash; copies of a text or a block count once.  Everything else covers all rows.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; a text that shares no
n-gram with any landmark has score 0; without labelled rows all is ``und``; null languages are not
learned; repeated rows are judged alike; an empty table gives no rows; other columns ride along in
``row``, whatever they are called.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditloom.llm.text import annotate, per_text, slices
from creditloom.sources.tables import materialise

FIT_BLOCKS = 2000
LANDMARKS = 256
RIDGE = 1e-2
BLOCK = 4096
ROWS_AT_ONCE = 256
UNKNOWN = "und"

#: Classes of bytes: 0 between words, 1 to 26 the letters whatever their case, the rest for bytes of other characters.
_CLASS = np.zeros(256, np.int32)
for _k in range(26):
    _CLASS[[65 + _k, 97 + _k]] = _k + 1
_CLASS[128:] = 27 + np.arange(128) % 37
CODES = 64**3 + 64**2 + 64


def _codes(classes: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(n, code of the n-gram that begins at each place) for n of 3, 2 and 1."""
    two = classes[:-1] * 64 + classes[1:]
    return [(3, two[:-1] * 64 + classes[2:]), (2, 64**3 + two), (1, 64**3 + 64**2 + classes)]


def blocks(off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of all texts' blocks, and how many blocks each text has."""
    size = np.diff(off)
    count = -(-size // BLOCK)
    first = np.repeat(off[:-1] - BLOCK * (np.cumsum(count) - count), count)
    return np.append(first + BLOCK * np.arange(count.sum()), off[-1]), count


def presence(raw: np.ndarray, bounds: np.ndarray, column: np.ndarray, width: int) -> np.ndarray:
    """A row for each block: which of the known n-grams it holds; no n-gram crosses blocks."""
    found = np.zeros((len(bounds) - 1, width + 1), np.float32)
    part = raw[bounds[0] : bounds[-1]]
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    if len(part) < 3:
        part, row = np.append(part, [32] * 3).astype(np.uint8), np.append(row, [len(bounds)] * 3)
    for n, codes in _codes(_CLASS[part]):
        begin = row[: len(codes)]
        inside = begin == row[n - 1 : n - 1 + len(codes)]
        inside &= begin < len(found)
        found[begin[inside], column[codes[inside]]] = 1
    return found[:, :width]


class Model:
    """Landmarks, the columns of their n-grams, and weights by language."""

    def __init__(self, languages: list[str], column: np.ndarray, landmarks: np.ndarray, weights: np.ndarray):
        self.languages, self.column, self.landmarks, self.weights = languages, column, landmarks, weights
        self.width = landmarks.shape[1]

    def margins(self, found: np.ndarray) -> np.ndarray:
        return kernel(found, self.landmarks) @ self.weights


def kernel(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Shared n-grams over the geometric mean of the set sizes; 0 for an empty set."""
    size = lambda x: np.sqrt(np.maximum(x.sum(axis=1), 1))
    return (one @ other.T) / (size(one)[:, None] * size(other)[None, :])


def _samples(labelled: DataFrame) -> DataFrame:
    """(lang, order, codes) of the blocks that the model is fitted on."""
    known = labelled.filter("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    known = known.withColumn("copy", F.xxhash64("text"))
    counts = materialise(known.groupBy("lang", "copy").agg(F.lit(1)).groupBy("lang").agg(F.count("*").alias("n")), "languages")
    each = max(20, FIT_BLOCKS // max(1, counts.count()))
    # enough rows for every language's share, then exactly its share by hash
    rate = F.lit(2.0 * each) / F.col("n")
    unit = (F.xxhash64("lang", "text") / F.lit(2.0**64)) + 0.5
    some = known.join(F.broadcast(counts) if counts.count() < 10_000 else counts, "lang").filter(unit < rate)
    some = some.dropDuplicates(["lang", "copy"]).select("lang", "text")
    narrow = some.select("lang", F.col("text").cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for rows, raw, off in slices(batches, "text"):
            bounds, count = blocks(off)
            langs = np.repeat(np.array(rows.column("lang").to_pylist(), object), count)
            out: list[list] = [[], [], []]
            for k, (s, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                part = raw[s:e]
                if not ((_CLASS[part] > 0).sum() > 20):
                    continue
                codes = np.unique(np.concatenate([c for _, c in _codes(_CLASS[part])]))
                out[0].append(langs[k])
                out[1].append(int.from_bytes(hashlib.blake2b(part.tobytes(), digest_size=8).digest(), "little", signed=True))
                out[2].append(codes)
            yield pa.record_batch([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int32()))], names=["lang", "order", "codes"])

    cut = narrow.mapInArrow(run, "lang string, order long, codes array<int>")
    cut = materialise(cut.dropDuplicates(["lang", "order"]), "blocks")
    # a text gives as many blocks as it is long: thin out before ranking, so that no language's rank is one huge sort
    made = cut.groupBy("lang").agg(F.count("*").alias("made"))
    thin = cut.join(made, "lang").filter((F.col("order") / F.lit(2.0**64)) + 0.5 < F.lit(3.0 * each) / F.col("made"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    return thin.withColumn("rank", rank).filter(F.col("rank") <= each).select("lang", "order", "codes")


def fit(labelled: DataFrame) -> Model | None:
    """The model of ``labelled`` (text, lang); None if there is nothing to learn from."""
    sample = _samples(labelled).toArrow().sort_by([("order", "ascending"), ("lang", "ascending")])
    langs = np.array(sample.column("lang").to_pylist(), object)
    if not len(langs):
        return None
    languages = sorted(set(langs))
    sets = [np.asarray(x, np.int64) for x in sample.column("codes").to_pylist()]
    # landmarks evenly among languages, in hash order
    turn = np.zeros(len(langs), np.int64)
    for name in languages:
        own = np.flatnonzero(langs == name)
        turn[own] = np.arange(len(own))
    chosen = np.argsort(turn, kind="stable")[:LANDMARKS]
    used = np.unique(np.concatenate([sets[k] for k in chosen]))
    column = np.full(CODES, len(used), np.int32)  # n-grams of no landmark share a column that is left out
    column[used] = np.arange(len(used))
    found = np.zeros((len(sets), len(used) + 1), np.float32)
    for k, codes in enumerate(sets):
        found[k, column[codes]] = 1
    found = found[:, :-1]
    landmarks = found[chosen]
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    good = values > 1e-6
    root = vectors[:, good] / np.sqrt(values[good])  # the kernel's inverse square root on its range
    features = np.hstack([kernel(found, landmarks) @ root, np.ones((len(found), 1))])
    target = np.where(langs[:, None] == np.array(languages, object)[None, :], 1.0, -1.0)
    ridge = RIDGE * np.eye(features.shape[1])
    ridge[-1, -1] = 0  # not the offset
    solved = np.linalg.solve(features.T @ features + ridge * len(found), features.T @ target)
    model = Model(languages, column, landmarks, (root @ solved[:-1]).astype(np.float32))
    model.offset = solved[-1].astype(np.float32)
    return model


def predict(docs: DataFrame, model: Model | None, keep: list[str] | None = None) -> DataFrame:
    """``row``, lang_pred and score (0 to 1) for every row; only the text is looked at."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows: pa.RecordBatch, raw: np.ndarray, off: np.ndarray) -> list:
        model, texts = held.value, len(off) - 1
        ascii_letters = (_CLASS[raw] > 0) & (raw < 128)
        lettered = per_text(ascii_letters, off) > 0
        high = per_text(raw >= 128, off) > 0
        for k in np.flatnonzero(~lettered & high).tolist():
            lettered[k] = any(c.isalpha() for c in raw[off[k] : off[k + 1]].tobytes().decode("utf-8", "ignore"))
        if model is None:
            return [[UNKNOWN] * texts, [0.0] * texts]
        bounds, count = blocks(off)
        owner = np.repeat(np.arange(texts), count)
        margins = np.zeros((texts, len(model.languages)))
        weight = np.zeros(texts)
        for at in range(0, len(owner), ROWS_AT_ONCE):
            some = bounds[at : at + ROWS_AT_ONCE + 1]
            found = presence(raw, some, model.column, model.width)
            letters = per_text(_CLASS[raw[some[0] : some[-1]]] > 0, some - some[0]) * (found.sum(axis=1) > 0)
            np.add.at(margins, owner[at : at + ROWS_AT_ONCE], (model.margins(found) + model.offset) * letters[:, None])
            np.add.at(weight, owner[at : at + ROWS_AT_ONCE], letters)
        margins /= np.maximum(weight, 1)[:, None]
        best = margins.argmax(axis=1)
        score = np.clip((margins[np.arange(texts), best] + 1) / 2, 0, 1) * (weight > 0)
        names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist())]
        return [names, np.where(lettered, score, 0.0)]

    return annotate(docs, run, "lang_pred string, score double", keep)


def fold(doc_id: Column) -> Column:
    """0 to 3; rows of fold 2 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4
