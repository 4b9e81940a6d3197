"""URL filters by a sort-merge range join.

A host with its labels in reverse, each ended by a zero byte, is the canonical key; zero bytes and
backslashes of the host itself are escaped.  A rule's host is a prefix of the keys of itself and all
its subdomains, so it is an interval of the sorted keys, and two intervals nest or are apart.  URLs are dealt out by ranges of (key, hash), so one host's URLs may
spread over many tasks; a rule goes to every range that its interval meets.  Each range is then one
sorted sweep with a stack of the rules that are open at the present key, outermost first.

The fitting rule with the longest host wins, then the one with the longest path; of rules that are
alike, block.  What no rule fits gets ``default``.

Edge cases: a null url, or one without "://", has an empty host and path and fits no rule; a rule
without host fits nothing; repeated rows are judged alike; an empty table gives no rows; other
columns ride along in ``row``, whatever they are called.
"""

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from creditloom.sources.tables import materialise

# Fixed values.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


END = "\x00"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column) -> Column:
    """Labels in reverse, each with END after it; empty for no host."""
    safe = F.replace(F.replace(host, F.lit("\\"), F.lit("\\\\")), F.lit(END), F.lit("\\0"))
    reverse = F.concat(F.array_join(F.reverse(F.split(safe, r"\.", -1)), END), F.lit(END))
    return F.when(host == "", F.lit("")).otherwise(reverse)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", ranges: int | None = None) -> DataFrame:
    """``row``, host, path, rule (host and path of the winner, or null) and verdict of every row of ``pages``.

    ``rules`` has verdict, host and path.
    """
    spark = pages.sparkSession
    url = pages["url"].cast("string")
    row = F.struct(*[pages[f"`{c}`"] for c in pages.columns])
    keyed = pages.select(row.alias("row"), host_of(url).alias("host"), path_of(url).alias("path"))
    keyed = keyed.select(canonical(F.col("host")).alias("key"), F.rand(17).alias("salt"), "host", "path", "row")
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written down, since the ranges are drawn anew whenever they are computed
    dealt = materialise(keyed.repartitionByRange(ranges, "key", "salt").withColumn("range", F.spark_partition_id()), "urls")
    bounds = sorted(tuple(x) for x in dealt.groupBy("range").agg(F.min("key"), F.max("key")).collect())
    numbers, lows, highs = [b[0] for b in bounds], [b[1].encode() for b in bounds], [b[2].encode() for b in bounds]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A copy of each rule for every range whose keys its interval meets."""
        for batch in batches:
            out = []
            for key, host, path, verdict in zip(*(batch.column(c).to_pylist() for c in ("key", "host", "path", "verdict"))):
                low = key.encode()
                first, last = bisect_left(highs, low), bisect_right(lows, low + b"\xff")
                out += [(numbers[k], key, host, path, verdict) for k in range(first, last)]
            columns = list(zip(*out)) or [[]] * 5
            kinds = [("range", pa.int32()), ("key", pa.string()), ("host", pa.string()), ("path", pa.string()), ("verdict", pa.string())]
            yield pa.record_batch([pa.array(v, t) for v, (_, t) in zip(columns, kinds)], names=[n for n, _ in kinds])

    host = F.translate(F.col("host"), UPPER, LOWER)
    own = rules.filter("host <> ''").select(canonical(host).alias("key"), host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    copies = own.mapInArrow(spread, "range int, key string, host string, path string, verdict string")
    nothing = F.lit(None).cast(dealt.schema["row"].dataType)
    events = dealt.select("range", "key", F.lit(1).alias("kind"), "host", "path", F.lit(None).cast("string").alias("verdict"), "row").unionByName(
        copies.select("range", "key", F.lit(0).alias("kind"), "host", "path", "verdict", nothing.alias("row"))
    )
    ordered = events.repartition(ranges, "range").sortWithinPartitions("range", "key", "kind")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = None
        stack: list[tuple[str, str, list]] = []  # (key, host, [(path, verdict)] longest first)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("range", "key", "kind", "host", "path", "verdict")]
            urls, found, verdicts = [], [], []
            for k, (number, key, kind, host, path, verdict) in enumerate(zip(*columns)):
                if number != present:
                    present, stack = number, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, host, []))
                    stack[-1][2].append((path, verdict))
                    stack[-1][2].sort(key=lambda x: (-len(x[0]), x[0], x[1] != "block"))
                    continue
                hit = next(((h + p, v) for _, h, own in reversed(stack) for p, v in own if path.startswith(p)), (None, default))
                urls.append(k)
                found.append(hit[0])
                verdicts.append(hit[1])
            kept = batch.select(["row", "host", "path"]).take(pa.array(urls, pa.int64()))
            arrays = [*kept.columns, pa.array(found, pa.string()), pa.array(verdicts, pa.string())]
            yield pa.record_batch(arrays, names=["row", "host", "path", "rule", "verdict"])

    fields = [StructField(c, StringType()) for c in ("host", "path", "rule", "verdict")]
    return ordered.mapInArrow(sweep, StructType([StructField("row", dealt.schema["row"].dataType), *fields]))
