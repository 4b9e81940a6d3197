"""Token totals by source, language and tokenizer version, maintained by signed deltas.

A batch of changes (documents inserted, deleted, or counted anew) becomes signed sums per key before
anything is stored: an insert adds its tokens, a delete takes them off, a revision adds the
difference.  Sums are additive, so totals are the sum over batches in any order, and a batch's cost
follows its changes, not the corpus.

A store is a folder: ``deltas`` has a partition per batch, ``commits`` a row per batch.  A batch
writes its partition, then its commit row; readers see committed batches only.  A batch that comes
again is recognised by its id and changes nothing; one that was lost half-way overwrites what it had
left.  ``compact`` folds committed batches into one; their ids stay known.

Edge cases: null source, language or tokenizer is a key of its own; null counts are 0; keys whose
documents and tokens are both 0 do not appear; repeated changes are separate changes; an empty batch
commits and adds nothing; other columns are ignored, whatever their names.
"""

import base64

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm.text import annotate

KEYS = ["source", "lang", "tokenizer"]
DELTAS = "source string, lang string, tokenizer string, docs long, tokens long, batch string"
COMMITS = "batch string, folds array<string>"

_ENCODERS: dict[str, object] = {}


def _encoder(path: str):
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _ENCODERS[path] = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def counted(docs: DataFrame, ranks: list[str], keep: list[str] | None = None, without: str = "") -> DataFrame:
    """``row`` and ``counts``: tokens of each whole text by each of the rank files.

    With ``without``, one count more: by the first file, of the text less those characters.
    """
    gone = str.maketrans("", "", without)

    def run(rows: pa.RecordBatch, raw, off) -> list:
        data = raw.tobytes()
        found = []
        for s, e in zip(off[:-1].tolist(), off[1:].tolist()):
            text = data[s:e].decode("utf-8", "replace")
            counts = [len(_encoder(path).encode_ordinary(text)) for path in ranks]
            if without:
                less = text.translate(gone)
                counts.append(len(_encoder(ranks[0]).encode_ordinary(less)) if len(less) < len(text) else counts[0])
            found.append(counts)
        return [found]

    return annotate(docs, run, "counts array<long>", keep)


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums per key of ``changes``: op (insert, delete, revise), KEYS, tokens and, for revise, old_tokens."""
    sign = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).when(F.col("op") == "revise", 0)
    sign = F.when(sign.isNull(), F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("null"))))).otherwise(sign)
    tokens = F.coalesce("tokens", F.lit(0)).cast("long")
    moved = F.when(F.col("op") == "revise", tokens - F.coalesce("old_tokens", F.lit(0)).cast("long")).otherwise(sign * tokens)
    return changes.groupBy(*[F.col(k).cast("string").alias(k) for k in KEYS]).agg(
        F.sum(sign).cast("long").alias("docs"), F.sum(moved).alias("tokens")
    )


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:  # the store's first batch
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _known(spark: SparkSession, store: str) -> tuple[set[str], set[str]]:
    """Ids of batches to be read, and of all that ever counted."""
    rows = _stored(spark, f"{store}/commits", COMMITS).collect()
    folded = {b for r in rows for b in r["folds"]}
    return {r["batch"] for r in rows} - folded, {r["batch"] for r in rows} | folded


def _put(spark: SparkSession, store: str, batch: str, sums: DataFrame, folds: list[str]) -> None:
    rows = sums.select(*KEYS, "docs", "tokens", F.lit(batch).alias("batch"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{store}/deltas")
    spark.createDataFrame([(batch, folds)], COMMITS).coalesce(1).write.mode("append").parquet(f"{store}/commits")


def commit(spark: SparkSession, store: str, batch: str, changes: DataFrame) -> bool:
    """Count ``changes`` as ``batch``; False if that batch already counts."""
    if batch in _known(spark, store)[1]:
        return False
    _put(spark, store, batch, deltas(changes), [])
    return True


def totals(spark: SparkSession, store: str) -> DataFrame:
    """KEYS, docs and tokens over all committed batches."""
    live, _ = _known(spark, store)
    rows = _stored(spark, f"{store}/deltas", DELTAS).filter(F.col("batch").isin(sorted(live)))
    summed = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    return summed.filter("docs <> 0 or tokens <> 0")


def compact(spark: SparkSession, store: str, name: str) -> None:
    """Fold all committed batches into the batch ``name``; the totals stay the same."""
    live, known = _known(spark, store)
    if name in known:
        return
    # known ids go along, so that a batch that comes again is still recognised
    _put(spark, store, name, totals(spark, store), sorted(known))
