"""What steps do per row, and what they send and write, on rows made here."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import functions as F

from ledgerline.operators import curve, partitions, states
from ledgerline.workload import inputs

D15 = date(2024, 1, 15)


def test_place_on_the_curve_is_made_once_per_row(warehouse, monkeypatch):
    spark, plans = warehouse.spark, []
    count = partitions.count_on_write

    def watched(frame, key_column):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return count(frame, key_column)

    monkeypatch.setattr(partitions, "count_on_write", watched)
    rows = spark.range(1000).select(
        F.lit(D15).alias("date"), (F.col("id") % 7).alias("a"), F.hex("id").alias("Curve")
    )
    path = f"{warehouse.root}/once"
    partitions.write_days(rows, path, ["date"], cluster_columns=("a", "Curve"))
    (sort,) = [line for line in plans[0].splitlines() if "Sort [" in line]
    assert "(" not in sort.split("Sort [")[1].split("]")[0]
    assert sorted(spark.read.parquet(path).columns) == ["Curve", "a", "date"]


def test_range_of_a_number_is_how_many_bounds_lie_below(spark):
    nan, inf = float("nan"), float("inf")
    values = [None, -inf, -1.5, -0.0, 0.0, 1.0, 2.0, 2.5, 9.0, inf, nan]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for bounds in ([], [0.0], [-1.5, 0.0, 2.0, 2.25, inf], [1.0, nan]):
        found = [r[0] for r in frame.select(curve._range(F.col("v"), bounds)).collect()]
        above = lambda v, b: v is not None and b == b and (v != v or v > b)
        assert found == [sum(above(v, b) for b in bounds) for v in values], bounds


def test_paypal_lines_are_numbered_before_they_become_pages(spark, tmp_path):
    spark.range(60).selectExpr(
        "id * 300 AS l_orderkey", "id + 7 AS l_partkey", "id AS l_suppkey",
        "CAST(1 + id % 7 AS INT) AS l_linenumber", "CAST(1 + id % 50 AS DOUBLE) AS l_quantity",
        "10.5D AS l_extendedprice", "0.0D AS l_discount", "0.05D AS l_tax",
        "if(id % 3 = 0, 'A', 'N') AS l_returnflag", "'O' AS l_linestatus",
        "date_add(DATE '1995-01-01', CAST(id % 4 AS INT)) AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    pages = inputs.fetched_paypal_pages(spark, str(tmp_path))
    assert pages.columns == ["landed_date", "page", "total_pages", "transaction_details"]
    steps = pages._jdf.queryExecution().optimizedPlan().toString().splitlines()
    (made,) = [n for n, step in enumerate(steps) if "Generate inline" in step]
    assert all(n > made for n, step in enumerate(steps) if "Window" in step or "Join" in step)
    of_day = {}
    for row in pages.collect():
        assert row.total_pages == 15
        of_day.setdefault(row.landed_date, []).append(row.page)
    assert len(of_day) == 4
    assert all(sorted(numbers) == list(range(1, 16)) for numbers in of_day.values())


def test_partitions_beyond_the_open_files_are_written_too(spark, tmp_path):
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(name, None)
    with partitions._open_files(spark, partitions.MOST_OPEN):
        seen.append(spark.conf.get(name))
    assert seen == [str(partitions.MOST_OPEN)] and spark.conf.get(name, None) == before
    rows = spark.range(4000, numPartitions=1).selectExpr(
        "date_add(DATE '2024-01-01', CAST(id * 7919 % 40 AS INT)) AS date", "id"
    )
    path = str(tmp_path / "days")
    assert partitions.write_days(rows, path, ["date"], rebalance=False).rows == 4000
    assert spark.read.parquet(path).select("date", "id").exceptAll(rows).isEmpty()
    assert spark.conf.get(name, None) == before


def test_keys_are_sent_without_the_content_of_their_rows(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame(
        [(D15, "a", 1), (D15, "a", 1), (D15, "b", 2), (None, "a", 3), (None, None, None)],
        "day date, k string, v int",
    )
    plans, coalesce = [], type(rows).coalesce

    def watched(frame, n):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return coalesce(frame, n)

    monkeypatch.setattr(type(rows), "coalesce", watched)
    states.keep(rows, str(tmp_path), "b", "day", ("day", "k"))
    by_key = re.findall(r"Aggregate \[[^\]]*k#[^\]]*\].*", plans[0])
    assert by_key and not any("xxhash64" in line for line in by_key)
    found = spark.read.parquet(f"{tmp_path}/_states/build=b").collect()
    assert {(r.day, r.rows, r["keys"], r.repeated, r.most) for r in found} == {
        (D15, 3, 2, 1, 2), (None, 2, 2, 0, 1)
    }
    content = rows.groupBy("day").agg(F.sum(F.xxhash64("day", "k", "v").cast("decimal(38,0)")).cast("string"))
    assert {(r.day, r.content) for r in found} == {tuple(r) for r in content.collect()}
