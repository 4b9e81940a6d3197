"""Ranked lexical search with bag deduplication.

Every document is ranked for every item of a set of queries.  All that its scores depend on is its
bag: how often it holds each term that some item has, and its length measure m.  So

1. one scan restricts documents to the items' vocabulary and counts N, L and the terms' document
   frequencies on the way;
2. documents of equal bag and m are one class: they meet by a hash, and the bags themselves are
   grouping keys too, so that what a hash brings together is verified;
3. each class is scored once, against all items, by matrix products of blocks of classes;
4. of an item, the best ``top`` classes, by score and then least doc_id, hold its best documents, as
   each class has a document at least as good as any in the classes after it;
5. those classes are expanded into their first ``top`` documents by doc_id, and ranked.

Scores are sums of products that stay below 2**53 for items of fewer than 300,000 terms (``Items``
checks it), so they are exact in double products.  Items are measured first: up to ``most_bytes``
of text they are broadcast, beyond that dealt into parts, and the documents are scanned once for each.

Hot classes: a class is a row after an aggregate that combines before the shuffle; its members are
cut to ``top`` by a window limit in every task, then for parts of the class, then for the class.

Edge cases: null and empty texts have no terms and are never listed; an item without terms lists
nothing; rows of one item_id are one item; a null item_id is an item; repeated documents are listed
each; rows without doc_id come after those with one; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditloom.llm.text import kept, lower_ascii, prefix_hash, range_hash, slices, word_table, words
from creditloom.sources.tables import materialise

# Fixed values of the score.
WEIGHT = 1000
SCALE = 1_000_000_000
LENGTH_SHARE = 50  # per cent of m that follows the document's length
SATURATION = 20

TOP = 50
MOST_BYTES = 2_000_000
ITEMS_AT_ONCE = 64
CLASSES_AT_ONCE = 512
PARTS_OF_CLASS = 64
HELD = 500_000  # candidates that a task holds before it keeps the best

#: Terms are runs of letters, digits and non-ASCII bytes.
TERMS = word_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def _terms(raw: np.ndarray, off: np.ndarray):
    """Hashes of all texts' terms, and each text's first term (one more at the end)."""
    low = lower_ascii(raw)
    starts, ends, first = words(low, off, TERMS)
    return range_hash(prefix_hash(low), starts, ends), first


class Items:
    """The items' vocabulary and, by blocks of items, which of its terms each has."""

    def __init__(self, rows: pa.Table):
        owner, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        ids: dict = {}
        for batch in rows.to_batches():
            for part, raw, off in slices(iter([batch]), "text"):
                found, first = _terms(raw, off)
                own = np.array([ids.setdefault(x, len(ids)) for x in part.column("item_id").to_pylist()], np.int64)
                owner.append(np.repeat(own, np.diff(first)))
                hashes.append(found)
        self.ids = list(ids)
        self.vocabulary, term = np.unique(np.concatenate(hashes), return_inverse=True)
        pairs = np.unique(np.concatenate(owner) * max(1, len(self.vocabulary)) + term)
        self.owner, self.term = np.divmod(pairs, max(1, len(self.vocabulary)))
        if len(pairs) and np.bincount(self.owner).max() >= 300_000:
            raise ValueError("an item has so many terms that its scores are no longer exact")

    def blocks(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(first item, its block's terms, terms x items) of every block."""
        out = []
        for begin in range(0, len(self.ids), ITEMS_AT_ONCE):
            s, e = np.searchsorted(self.owner, [begin, begin + ITEMS_AT_ONCE])
            used, column = np.unique(self.term[s:e], return_inverse=True)
            has = np.zeros((len(used), min(ITEMS_AT_ONCE, len(self.ids) - begin)))
            has[column, self.owner[s:e] - begin] = 1
            out.append((begin, used, has))
        return out


def bags(docs: DataFrame, held) -> DataFrame:
    """doc_id, n (its terms) and bag (term and tf, as 32-bit integers) of every row with terms, and counts (term, df) of each task.

    Counts of term -1: the documents with terms in df, all their terms in n.
    """
    narrow = docs.select("doc_id", docs["text"].cast("string").cast("binary").alias("text")).filter("text is not null")
    key = dict(narrow.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(None)
        vocabulary = held.value.vocabulary
        size = len(vocabulary)
        df, documents, terms, kind = np.zeros(size, np.int64), 0, 0, None
        for rows, raw, off in slices(batches, "text"):
            kind = rows.schema.field("doc_id").type
            hashes, first = _terms(raw, off)
            length = np.diff(first)
            documents += int(np.count_nonzero(length))
            terms += len(hashes)
            if size:
                at = np.minimum(np.searchsorted(vocabulary, hashes), size - 1)
                known = vocabulary[at] == hashes
                text = np.repeat(np.arange(len(length)), length)
                pairs, tf = np.unique(text[known] * size + at[known], return_counts=True)
                text, term = np.divmod(pairs, size)
                df += np.bincount(term, minlength=size)
            else:
                text, term, tf = (np.zeros(0, np.int64),) * 3
            flat = np.stack([term, tf], axis=1).astype("<i4")
            bounds = np.searchsorted(text, np.arange(len(length) + 1))
            some = np.flatnonzero(length)
            yield pa.record_batch(
                {
                    "doc_id": rows.column("doc_id").take(pa.array(some)),
                    "n": pa.array(length[some], pa.int64()),
                    "bag": pa.array([flat[bounds[k] : bounds[k + 1]].tobytes() for k in some.tolist()], pa.binary()),
                    "term": pa.nulls(len(some), pa.int32()),
                    "df": pa.nulls(len(some), pa.int64()),
                }
            )
        if kind is not None:
            used = np.flatnonzero(df)
            yield pa.record_batch(
                {
                    "doc_id": pa.nulls(len(used) + 1, kind),
                    "n": pa.array([terms] + [None] * len(used), pa.int64()),
                    "bag": pa.nulls(len(used) + 1, pa.binary()),
                    "term": pa.array(np.append(-1, used), pa.int32()),
                    "df": pa.array(np.append(documents, df[used]), pa.int64()),
                }
            )

    return narrow.mapInArrow(run, f"doc_id {key}, n long, bag binary, term int, df long")


def weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.array([floor(WEIGHT * log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.float64)


def scored(classes: DataFrame, held, weight: np.ndarray, top: int) -> DataFrame:
    """(item, score, least, class): of each task's ``classes`` (class, m, bag, least), each item's best ``top``, and no others."""
    heavy = classes.sparkSession.sparkContext.broadcast(weight)
    key = dict(classes.dtypes)["least"]
    order = [("item", "ascending"), ("score", "descending"), ("least", "ascending")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = held.value, heavy.value
        blocks, size = items.blocks(), len(items.vocabulary)
        floor_of = np.ones(len(items.ids))  # a score that an item's best must reach
        parts: list[pa.Table] = []
        waiting = 0

        def best() -> pa.Table:
            table = pa.concat_tables(parts).sort_by(order)
            item = table.column("item").to_numpy()
            begin = np.searchsorted(item, item)
            table = table.filter(pa.array(np.arange(len(item)) - begin < top))
            item, score = table.column("item").to_numpy(), table.column("score").to_numpy()
            full = np.flatnonzero(np.bincount(item, minlength=len(floor_of)) >= top)
            floor_of[full] = score[np.searchsorted(item, full, "right") - 1]
            return table

        for batch in batches:
            for at in range(0, batch.num_rows, CLASSES_AT_ONCE):
                rows = batch.slice(at, CLASSES_AT_ONCE)
                raw = rows.column("bag").to_pylist()
                flat = np.frombuffer(b"".join(raw), "<i4").reshape(-1, 2).astype(np.int64)
                row = np.repeat(np.arange(len(raw)), [len(x) // 8 for x in raw])
                term, tf = flat[:, 0], flat[:, 1]
                m = rows.column("m").to_numpy()[row]
                value = np.zeros((len(raw), size))
                value[row, term] = weight[term] * ((SCALE * tf) // (WEIGHT * tf + SATURATION * m))
                for begin, used, has in blocks:
                    score = value[:, used] @ has
                    who, item = np.nonzero(score >= floor_of[begin : begin + has.shape[1]])
                    if not len(who):
                        continue
                    chosen = rows.select(["least", "class"]).take(pa.array(who))
                    parts.append(pa.table(
                        {"item": pa.array(item + begin, pa.int32()), "score": pa.array(score[who, item].astype(np.int64)), "least": chosen.column(0), "class": chosen.column(1)}
                    ))
                    waiting += len(who)
                if waiting > HELD:
                    parts = [best()]
                    waiting = 0
        if parts:
            yield from best().to_batches()

    return classes.mapInArrow(run, f"item int, score long, least {key}, class long")


def _first(rows: DataFrame, top: int, by: list, order: list) -> DataFrame:
    """The first ``top`` of ``rows`` for each ``by``, with their rank."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, most_bytes: int = MOST_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: of each of ``items`` (item_id, text), the ``top`` best of ``docs`` (doc_id, text) with a score above 0."""
    queries = items.select("item_id", F.col("text").cast("string").cast("binary").alias("text")).filter("text is not null")
    size = queries.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    parts = max(1, -(-size // most_bytes))
    found = []
    for part in range(parts):
        some = queries if parts == 1 else queries.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        found.append(_search(docs, items.schema["item_id"].dataType, Items(some.toArrow()), top))
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def _search(docs: DataFrame, item_type, items: Items, top: int) -> DataFrame:
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(items)
    scanned = materialise(bags(docs, held), "bags")
    counts = scanned.filter("term is not null").groupBy("term").agg(F.sum("df").alias("df"), F.sum("n").alias("n")).collect()
    df, documents, terms = np.zeros(len(items.vocabulary), np.int64), 0, 0
    for term, found, n in counts:
        if term < 0:
            documents, terms = found, n
        else:
            df[term] = found
    m = F.expr(f"{100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * {documents}L) div {max(terms, 1)}L")
    rows = scanned.filter("term is null and length(bag) > 0").select("doc_id", m.alias("m"), "bag")
    rows = rows.select("doc_id", "m", "bag", F.xxhash64("m", "bag").alias("hash"))
    # the hash brings a class together, m and the bag verify it
    classes = rows.groupBy("hash", "m", "bag").agg(F.min("doc_id").alias("least"))
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    by_score = [F.desc("score"), F.asc_nulls_last("least")]
    best = _first(scored(classes.select("class", "m", "bag", "least"), held, weights(documents, df), top), top, ["item"], by_score)
    best = materialise(best.select("item", "score", "class"), "best")

    wanted = materialise(classes.join(best.select("class").distinct(), "class", "left_semi").select("class", "hash", "m", "bag"), "wanted")
    members = rows.join(wanted.withColumnRenamed("hash", "h").withColumnRenamed("m", "k").withColumnRenamed("bag", "b"), F.expr("hash = h and m = k and bag = b"))
    by_id = [F.asc_nulls_last("doc_id")]
    dealt = members.select("class", "doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS_OF_CLASS)).alias("part"))
    some = _first(dealt, top, ["class", "part"], by_id).drop("rank")
    some = _first(some, top, ["class"], by_id).select("class", "doc_id")
    listed = _first(best.join(some, "class"), top, ["item"], [F.desc("score"), F.asc_nulls_last("doc_id")])
    ids = spark.createDataFrame(list(enumerate(items.ids)), _id_schema(item_type))
    return listed.join(ids, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _id_schema(item_type):
    from pyspark.sql.types import IntegerType, StructField, StructType

    return StructType([StructField("item", IntegerType()), StructField("item_id", item_type)])
