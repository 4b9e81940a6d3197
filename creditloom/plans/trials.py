"""The trials of a search as a table: what was tried stays tried when the driver is lost.

A folder holds, for one search (what is searched, over which rows), the rows with their folds and a
row for each (draw, fold) with its score.  A trial is committed by one small write into a partition
of its own, so a trial that runs twice is there once.  A search that starts again in the folder
reads rows and folds from storage and fits only what has no score.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.sources.tables import exists, materialise

SCHEMA = "score double, draw int, fold int"


class Trials:
    """``path``: the folder, or None to keep nothing.  ``what``: a text that tells searches apart."""

    def __init__(self, spark: SparkSession, path: str | None, what: str = ""):
        self.spark, self.what = spark, what
        self.home, self.table = path.rstrip("/") if path else None, None

    def rows(self, frame: DataFrame) -> DataFrame:
        """The rows of the search: ``frame``, or what the search that was cut off had stored of an equal frame."""
        if not self.home:
            return materialise(frame, "search-rows")
        whole = F.xxhash64(*[F.col(f"`{c}`") if not t.startswith("struct") else F.to_json(F.col(f"`{c}`")) for c, t in _plain(frame).dtypes])
        seen = _plain(frame).agg(F.count("*"), F.sum(whole.cast("decimal(38,0)"))).first()
        digest = hashlib.sha256(repr((self.what, frame.columns, *seen)).encode()).hexdigest()[:16]
        home = f"{self.home}/search={digest}"
        self.table = f"{home}/trials"
        if not exists(self.spark, f"{home}/rows/_SUCCESS"):
            frame.write.mode("overwrite").parquet(f"{home}/rows")
        return self.spark.read.parquet(f"{home}/rows")

    def done(self) -> dict[tuple[int, int], float]:
        """The scores that are committed."""
        if not self.table or not exists(self.spark, self.table):
            return {}
        return {(r["draw"], r["fold"]): r["score"] for r in self.spark.read.schema(SCHEMA).parquet(self.table).collect()}

    def commit(self, scores: dict[tuple[int, int], float]) -> None:
        if not self.table:
            return
        rows = self.spark.createDataFrame([(s, d, f) for (d, f), s in scores.items()], SCHEMA)
        (
            rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("draw", "fold").parquet(self.table)
        )

    def run(
        self, wanted: list[tuple[int, int]], try_out: Callable[[list[tuple[int, int]]], list[float]], at_once: int, parallelism: int,
    ) -> dict[tuple[int, int], float]:
        """Scores of all ``wanted``: of those without one, ``at_once`` go to one call of ``try_out``, and ``parallelism`` calls run at a time."""
        scores = self.done()
        left = [x for x in wanted if x not in scores]
        parts = [left[k : k + at_once] for k in range(0, len(left), at_once)]

        def one(part: list[tuple[int, int]]) -> dict[tuple[int, int], float]:
            found = dict(zip(part, try_out(part), strict=True))
            self.commit(found)
            return found

        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            for found in pool.map(one, parts):
                scores.update(found)
        return scores


def _plain(frame: DataFrame) -> DataFrame:
    """``frame`` with model vectors as arrays, which can be hashed."""
    from pyspark.ml.functions import vector_to_array

    return frame.select(*[
        vector_to_array(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() == "vectorudt" or "vector" in f.dataType.simpleString() else F.col(f"`{f.name}`")
        for f in frame.schema
    ])
