"""The reader of CSV by blocks against Python's own."""

import csv
import random

import pytest

from creditloom.sources import csv_blocks

COLUMNS = ["id", "text", "more"]


def _write(path, rows, end="\n", last=True, header=COLUMNS):
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=end)
        writer.writerow(header)
        writer.writerows(rows)
    if not last:
        raw = open(path, "rb").read()
        open(path, "wb").write(raw[: -len(end)])


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _rows(seed, n=200):
    pick = random.Random(seed)
    odd = ["plain", "a,b", 'say "x"', "two\nlines", "\n\n", '"', '""', "\n\"\n,\"\n", "é\n中", " blanks ", "x" * 900 + "\n" + "y" * 900, "'"]
    return [[str(k), pick.choice(odd), pick.choice(odd)] for k in range(n)]


@pytest.mark.parametrize("seed, end, last", [(1, "\n", True), (2, "\r\n", True), (3, "\n", False)])
def test_records_over_many_blocks(spark, tmp_path, small_blocks, seed, end, last):
    rows = _rows(seed)
    _write(tmp_path / "a.csv", rows, end, last)
    assert csv_blocks.lines(spark, str(tmp_path)).select("block").distinct().count() > 20
    got = sorted((tuple(r) for r in csv_blocks.read(spark, str(tmp_path), COLUMNS).collect()), key=lambda r: int(r[0]))
    assert got == [tuple(r) for r in rows]


def test_files_with_their_own_headers(spark, tmp_path, small_blocks):
    one, two = _rows(5, 40), _rows(6, 40)
    _write(tmp_path / "a.csv", one)
    _write(tmp_path / "b.csv", [[r[1], r[0], "z"] for r in two], header=["text", "id", "other"])
    _write(tmp_path / "c.csv", [])
    (tmp_path / "d.csv").write_text("")
    got = sorted((tuple(r) for r in csv_blocks.read(spark, str(tmp_path), COLUMNS).collect()), key=str)
    assert got == sorted([tuple(r) for r in one] + [(r[0], r[1], None) for r in two], key=str)


def test_nothing(spark, tmp_path):
    (tmp_path / "d.csv").write_text("")
    assert csv_blocks.read(spark, str(tmp_path), COLUMNS).isEmpty()


def test_as_the_one_task_reader(spark, tmp_path, small_blocks):
    from creditloom.sources import tables

    _write(tmp_path / "a.csv", _rows(9, 60))
    usual = spark.read.options(**tables.CSV_TEXT, multiLine=True).csv(str(tmp_path / "a.csv"))
    assert sorted(map(str, usual.collect())) == sorted(map(str, csv_blocks.read(spark, str(tmp_path / "a.csv"), COLUMNS).collect()))
