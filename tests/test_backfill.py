"""A backfill makes the months whose input changed, and no others."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from creditloom.catalog.lake import Lake
from creditloom.operators import labels, silver
from creditloom.plans import stages
from creditloom.sources import tables

SPAN = ("1998-09-01", "1998-12-01")


@pytest.fixture(scope="module")
def raw(spark):
    lake = Lake(spark, "/root/testdata/sf0.001")
    return {name: tables.materialise(stages.Span(*SPAN).apply(df).selectExpr([f"cast(`{c}` as {'date' if c == 'snapshot_date' else 'string'}) as `{c}`" for c in df.columns]), "raw") for name, df in lake.raw.items()}


def _files(root):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{root}/**/part-*", recursive=True) if "input_digests" not in p}


def _months(paths):
    return {p.split("snapshot_date=")[1][:10] for p in paths}


def test_only_changed_months_are_made(spark, raw, tmp_path):
    layout = stages.Layout(str(tmp_path))
    run = lambda sources, **more: stages.backfill(spark, sources, layout, *SPAN, force=False, **more)
    first = run(raw)
    assert first == ["1998-09-01", "1998-10-01", "1998-11-01", "1998-12-01"]
    before = _files(tmp_path)
    assert run({name: df.repartition(3) for name, df in raw.items()}) == []  # the same rows in another order
    assert _files(tmp_path) == before

    paid = F.when((F.col("snapshot_date") == "1998-10-01") & (F.col("installment_num") == "1"), F.lit("0.0")).otherwise(F.col("paid_amt"))
    changed = {**raw, "loan_daily": raw["loan_daily"].withColumn("paid_amt", paid)}
    assert run(changed) == ["1998-10-01"]
    after = _files(tmp_path)
    assert _months(p for p in after if before.get(p) != after[p]) == {"1998-10-01"}
    assert _months(p for p in before if p not in after) == {"1998-10-01"}

    whole = stages.Layout(str(tmp_path / "whole"))
    stages.backfill(spark, changed, whole, *SPAN)
    for path, other in ((layout.labels, whole.labels), (layout.features, whole.features)):
        one, two = tables.read_table(spark, path), tables.read_table(spark, other)
        assert one.count() == two.count() and one.select(two.columns).exceptAll(two).isEmpty()


def test_other_rules_and_lost_runs_make_months_again(spark, raw, tmp_path, monkeypatch):
    layout = stages.Layout(str(tmp_path))
    some = ("1998-11-01", "1998-12-01")
    monkeypatch.setattr(stages, "build_gold", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        stages.backfill(spark, raw, layout, *some, force=False)
    monkeypatch.undo()
    assert stages.backfill(spark, raw, layout, *some, force=False) == ["1998-11-01", "1998-12-01"]
    assert stages.backfill(spark, raw, layout, *some, force=False) == []
    other = labels.LabelRule(60, labels.PAYMENT_RULE.mob)
    assert stages.backfill(spark, raw, layout, *some, silver.STRIP_FIRST, other, force=False) == ["1998-11-01", "1998-12-01"]
    assert len(stages.backfill(spark, raw, layout, *some)) == 2
