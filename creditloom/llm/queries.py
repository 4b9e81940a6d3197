"""The registered queries of the operators: name -> function of (spark, folder of the tables)."""

import functools
import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import (
    decontaminate, fertility, guesses, jaccard, langid, packing, ranking, ring, rollups, spelling, suffix, url_rules, warc,
)
from creditloom.sources.tables import materialise, shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def importable(spark: SparkSession) -> None:
    """Let workers that start from here on import this package, wherever the driver was started."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, known), home])


def query(build: Callable[[SparkSession, str], DataFrame]):
    """Register under the function's name."""

    @functools.wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenise(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces)


@query
def op2_tokenizer_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    measured = fertility.measure(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id", "lang"])
    judged = fertility.judge(measured, F.col("row.lang"))
    return judged.select("row.doc_id", *[c for c in judged.columns if c != "row"])


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return marked.select(
        "row.doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


@query
def op9_suffix_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.removed(table(spark, sf_dir, "documents"), keep=["doc_id"], passage=suffix.PASSAGE)
    return found.select(
        "row.doc_id", "n_bytes", "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),  # of a character that a cut parts, a mark stays
        "n_passage", F.size("passages").cast("long").alias("n_passages"),
    )


@query
def op1_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op6_url_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_rules.RULES, "verdict string, host string, path string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, rules).select("row.page_id", "host", "path", "rule", "verdict")


@query
def op7_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.shard_documents(table(spark, sf_dir, "documents"), shards=8).select(
        "row.*", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home"
    )


@query
def op5_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in; toxic ones go; poor ones are counted anew without symbols; other languages change tokenizer."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    first, second = "byte_bpe_50k", "byte_bpe_multi_50k"
    paths = [public_tokenizers.path(f"{name}.tiktoken") for name in (first, second)]
    keep = ["doc_id", "source", "lang"]
    # the new counts are taken in the same pass, so that no text has to meet its labels in a join
    counts = rollups.counted(docs, paths, keep, without="#*$%&|<>")
    counts = counts.select("row.*", *[F.col("counts")[k].alias(f"n{k}") for k in (0, 1, 2)])
    counts = materialise(counts, "counts")
    marked = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    toxic = marked.filter("toxic = 1").select("doc_id")
    poor = marked.filter("quality = 0 and coalesce(toxic, 0) <> 1").select("doc_id")

    change = lambda op, tokenizer, tokens, old=F.lit(None): [
        F.lit(op).alias("op"), "source", "lang", F.lit(tokenizer).alias("tokenizer"), tokens.alias("tokens"), old.cast("long").alias("old_tokens")
    ]
    inserted = counts.select(*change("insert", first, F.col("n0")))
    deleted = counts.join(toxic, "doc_id").select(*change("delete", first, F.col("n0")))
    revised = counts.join(poor, "doc_id").select(*change("revise", first, F.col("n2"), F.col("n0")))
    others = counts.filter("lang <> 'en'").join(marked.filter("toxic = 1 or quality = 0").select("doc_id"), "doc_id", "left_anti")
    moved = others.select(*change("delete", first, F.col("n0"))).unionByName(others.select(*change("insert", second, F.col("n1"))))

    store = shared_dir(spark, "rollups")
    for batch, changes in (("1-load", inserted), ("2-toxic", deleted), ("3-symbols", revised), ("1-load", inserted), ("4-tokenizer", moved)):
        rollups.commit(spark, store, batch, changes)
    rollups.compact(spark, store, "5-all")
    rollups.commit(spark, store, "2-toxic", deleted)  # comes again, and is recognised
    return rollups.totals(spark, store)


@query
def op10_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.fold(F.col("doc_id")) == 2
    model = langid.fit(docs.filter(~held_out).select("text", "lang"))
    found = langid.predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("row.doc_id", (langid.fold(F.col("row.doc_id")) == 2).alias("held_out"), "lang_pred", "score")


@query
def op11_spelling_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), spelling.DROP_EVERY)


@query
def op12_secret_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = guesses.scan(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])
    base = F.filter("spans", lambda x: x["kind"] != "guess")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "row.doc_id", count("assign"), count("access"), count("hex"), F.sha2(guesses.listed(base), 256).alias("base_sha256"),
        guesses.listed(F.col("spans")).alias("spans"), count("guess"),
    )


@query
def op13_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
