"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Each shard has many points on a ring of 64-bit hashes; a key belongs to the first point clockwise.
Loads are bounded: with n rows, every shard takes n // shards of them, and the first n % shards
shards one more.  Keys come in the order of a second hash; one whose shard is full goes on clockwise
to the first that is not.  Sizes in rows are thus at most one apart, and when a shard joins, only
keys of its arcs and those displaced by the smaller bounds move.

In that order a shard fills up once and stays full, so there are at most as many events as shards,
and between two events a key's shard depends on its arc alone.  Rows are put into order and numbered
once (range partitions, a running number in each); each event is found by one count over (partition,
shard) and one look into the partition where the first bound is met.  The driver sees those counts,
never keys.

Edge cases: null texts are sized as 1; rows without doc_id share one place on the ring and are
spread by the bounds like any hot key; repeated rows are rows like others; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditloom.sources.tables import materialise

POINTS = 128
ROWS_PER_PARTITION = 250_000


class Ring:
    """The points of ``shards`` shards, and for each arc the shards in clockwise order."""

    def __init__(self, shards: int, points: int = POINTS):
        owned = sorted(
            (int.from_bytes(hashlib.blake2b(f"{s}/{p}".encode(), digest_size=8).digest(), "little", signed=True), s)
            for s in range(shards) for p in range(points)
        )
        self.shards = shards
        self.places = np.array([x for x, _ in owned], np.int64)
        self.clockwise: list[list[int]] = [[] for _ in owned]
        for k in range(len(owned)):
            self.clockwise[k] = list(dict.fromkeys(s for _, s in owned[k:] + owned[:k]))

    def arc(self, place: Column) -> Column:
        """Number of the first point at or after a key's place; beyond the last it is the first."""
        places = self.places

        @F.pandas_udf("int")
        def search(at: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(places, at.to_numpy()) % len(places)).astype("int32")

        return search(place)

    def owner(self, arc: int, full: set[int]) -> int | None:
        return next((s for s in self.clockwise[arc] if s not in full), None)


def _owners(df: DataFrame, ring: Ring, full: set[int], name: str) -> DataFrame:
    """``df`` with the shard of its arc while ``full`` shards are full; a table of shards x points rows is joined."""
    table = [(a, ring.owner(a, full)) for a in range(len(ring.places))]
    owners = df.sparkSession.createDataFrame(table, f"arc int, {name} int")
    return df.join(F.broadcast(owners), "arc")


def assign(keys: DataFrame, key: Column, tie: Column, shards: int, points: int = POINTS) -> DataFrame:
    """``keys`` with home (shard if none were full), shard and slot (gapless from 0 in each shard).

    ``tie`` orders rows of one key; rows alike in both are taken in any order.
    """
    ring = Ring(shards, points)
    count = keys.count()
    parts = max(1, -(-count // ROWS_PER_PARTITION))
    arrival = F.xxhash64(F.lit("arrival"), key, tie)
    given = F.struct(*[keys[f"`{c}`"] for c in keys.columns])
    dealt = keys.select(given.alias("row"), F.xxhash64(key).alias("place"), arrival.alias("arrival"))
    dealt = dealt.repartitionByRange(parts, "arrival").withColumn("part", F.spark_partition_id())
    dealt = materialise(dealt.select("row", "arrival", "part", ring.arc(F.col("place")).alias("arc")), "arrivals")
    number = F.row_number().over(Window.partitionBy("part").orderBy("arrival"))
    numbered = materialise(dealt.select("row", "part", "arc", number.alias("number")), "numbered")

    room = {s: count // shards + (s < count % shards) for s in range(shards)}
    full = {s for s, r in room.items() if r == 0}
    since = (-1, 0)  # the row that the last event came with
    phases: list[tuple[tuple[int, int], set[int]]] = [(since, set(full))]
    while len(full) < shards - 1 and count:
        later = numbered.filter((F.col("part") > since[0]) | ((F.col("part") == since[0]) & (F.col("number") > since[1])))
        going = _owners(later, ring, full, "shard")
        counts: dict[int, dict[int, int]] = {}
        for part, shard, n in going.groupBy("part", "shard").count().collect():
            counts.setdefault(part, {})[shard] = n
        for part in sorted(counts):
            if any(room[s] <= n for s, n in counts[part].items()):
                break
            for s, n in counts[part].items():
                room[s] -= n
        else:
            break
        # the first row of this partition with which a shard is full
        near = [s for s, n in counts[part].items() if room[s] <= n]
        order = F.row_number().over(Window.partitionBy("shard").orderBy("number"))
        inside = going.filter((F.col("part") == part) & F.col("shard").isin(near)).select("shard", "number", order.alias("k"))
        want = F.coalesce(*[F.when(F.col("shard") == s, F.lit(room[s])) for s in near])
        shard, at = min(((s, n) for s, n in inside.filter(F.col("k") == want).select("shard", "number").collect()), key=lambda x: x[1])
        before = going.filter((F.col("part") == part) & (F.col("number") <= at)).groupBy("shard").count().collect()
        for s, n in before:
            room[s] -= n
        full.add(shard)
        full |= {s for s, r in room.items() if r == 0}
        since = (part, at)
        phases.append((since, set(full)))

    placed = _owners(numbered, ring, set(), "home")
    phase = F.lit(0)
    for k, ((part, at), _) in enumerate(phases[1:], 1):
        phase = F.when((F.col("part") > part) | ((F.col("part") == part) & (F.col("number") > at)), F.lit(k)).otherwise(phase)
    table = [(k, a, ring.owner(a, f)) for k, (_, f) in enumerate(phases) for a in range(len(ring.places))]
    shards_of = keys.sparkSession.createDataFrame(table, "phase int, arc int, shard int")
    placed = placed.withColumn("phase", phase).join(F.broadcast(shards_of), ["phase", "arc"])
    # slots: those of the partitions before, then a running number
    sums = placed.groupBy("part", "shard").count()
    begun = sums.select("part", "shard", (F.sum("count").over(Window.partitionBy("shard").orderBy("part")) - F.col("count")).alias("begun"))
    running = F.row_number().over(Window.partitionBy("part", "shard").orderBy("number"))
    slotted = placed.withColumn("running", running).join(begun, ["part", "shard"])
    return slotted.select("row", "home", "shard", (F.col("begun") + F.col("running") - 1).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 8, points: int = POINTS) -> DataFrame:
    """``row`` (doc_id, size, text_crc32), home, shard and slot of every document."""
    raw = F.col("text").cast("string").cast("binary")
    sized = docs.select(
        "doc_id",
        (F.coalesce(F.length(raw), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(raw, F.lit(b""))).alias("text_crc32"),
    )
    return assign(sized, F.col("doc_id"), F.struct("text_crc32", "size"), shards, points)
