"""Sinks, ingest from files, rebuilds, audits and the calendar."""

from __future__ import annotations

import json
import os
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.calc import new_york_day, whole_months
from ledgerline.operators import attempts, files, snapshots
from ledgerline.operators.partitions import (
    Written,
    list_days,
    write_days,
)
from ledgerline.operators.quality import AuditError, assert_no_nulls, repeated_keys
from ledgerline.operators.run_days import calendar_days, missing_days
from ledgerline.plans import ingest as loads
from ledgerline.plans import runner
from ledgerline.plans.models import MODELS, model
from ledgerline.plans.runner import run_all_models, run_model
from ledgerline.schemas import RAW
from ledgerline.session import sized_for
from ledgerline.sources.landed import read_documents

RUN_TIME = datetime(2024, 2, 1, 6, 0, tzinfo=UTC)
D15, D16, D17 = (date(2024, 1, n) for n in (15, 16, 17))


def land(folder, day, *documents):
    path = f"{folder}/landed_date={day.isoformat()}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{len(os.listdir(path))}.json", "w") as file:
        file.writelines(json.dumps(d) + "\n" for d in documents)


def seconds(day):
    return int(datetime(day.year, day.month, day.day, 12, tzinfo=UTC).timestamp())


def charge(key, day, amount=1000):
    return {
        "id": key,
        "created": seconds(day),
        "amount": amount,
        "amount_captured": amount,
        "balance_transaction": {"fee": 30, "net": 970},
        "currency": "usd",
        "status": "succeeded",
        "billing_details": {"email": "a@example.com", "name": "A"},
    }


def page(*charges, after=None, more=False):
    body = {"data": list(charges), "has_more": more}
    return {**body, "starting_after": after} if after else body


def insight(day, clicks="5"):
    return {
        "date_start": day.isoformat(),
        "campaign_id": "c1",
        "campaign_name": "n",
        "impressions": "10",
        "clicks": clicks,
        "spend": "1.5",
        "reach": "3",
        "frequency": "1.0",
    }


def run(source, folder, warehouse, start, end, run_id="r1", **options):
    documents = read_documents(
        warehouse.spark, str(folder), source.landed_schema, start, end
    )
    log = loads.ingest(
        source, documents, warehouse, start, end, run_id, RUN_TIME, **options
    )
    return {row.partition_date: row for row in log.collect()}


def test_ingest_stripe_from_files(warehouse, tmp_path):
    land(tmp_path, D15, page(charge("ch_1", D15), more=True))
    land(tmp_path, D15, page(charge("ch_2", D15), after="ch_1"))
    land(tmp_path, D16, page(charge("ch_3", D16)))
    log = run(loads.STRIPE, tmp_path, warehouse, D15, D17)
    assert {d: (r.status, r.rows_loaded) for d, r in log.items()} == {
        D15: ("loaded", 2),
        D16: ("loaded", 1),
        D17: ("missing", 0),
    }
    assert "/lake/stripe_charges/partition_date=2024-01-15/run_id=r1" in log[D15].uri
    table = warehouse.read("raw.stripe_charges")
    assert table.schema.names[-1] == "charge_date"
    assert {(r.charge_id, r.charge_date) for r in table.collect()} == {
        ("ch_1", D15),
        ("ch_2", D15),
        ("ch_3", D16),
    }
    assert table.select("loaded_at").distinct().count() == 1
    assert table.where("charge_id = 'ch_1'").head().gross_amount_usd == Decimal(10)


def payment(key, written, day):
    return {
        "transaction_info": {
            "transaction_id": key,
            "transaction_initiation_date": f"{day.isoformat()}T{written}",
            "transaction_amount": {"value": "9.50", "currency_code": "USD"},
            "transaction_status": "S",
        }
    }


def numbered(*payments):
    return {"page": 1, "total_pages": 1, "transaction_details": list(payments)}


def test_a_record_of_another_day_stops_the_run_before_anything_is_lost(warehouse, tmp_path):
    land(tmp_path, D15, numbered(payment("a", "10:00:00+0000", D15), payment("b", "11:00:00+0000", D15)))
    run(loads.PAYPAL, tmp_path, warehouse, D15, D15, "r1")
    # Still the 15th as written, but the 16th as an instant: the run of the 16th gets it.
    land(tmp_path, D16, numbered(payment("c", "23:30:00-0500", D15), payment("e", "09:00:00+0000", D16)))
    with pytest.raises(Exception, match="transaction_date of another run day"):
        run(loads.PAYPAL, tmp_path, warehouse, D16, D16, "r2")
    log = run(loads.PAYPAL, tmp_path, warehouse, D15, D16, "r3", on_bad_record=loads.FAIL_DAY)
    assert [log[day].status for day in (D15, D16)] == ["loaded", "failed"]
    kept = warehouse.read("raw.paypal_transactions").collect()
    assert {(r.transaction_id, r.transaction_date) for r in kept} == {("a", D15), ("b", D15)}


def test_a_range_gives_what_its_days_give(warehouse, tmp_path):
    land(tmp_path, D15, page(charge("on", D15), charge("late", D16)))
    land(tmp_path, D16, page(charge("early", D15), charge("two", D16)))
    found = []
    for ranges in ([(D15, D16)], [(D15, D15), (D16, D16)]):
        for start, end in ranges:
            run(loads.STRIPE, tmp_path, warehouse, start, end, f"r{len(found)}")
        rows = warehouse.read("raw.stripe_charges").collect()
        found.append({(r.charge_id, r.charge_date) for r in rows})
    assert found == [{("on", D15), ("two", D16)}] * 2


def test_a_run_id_may_be_used_again_for_fewer_days(warehouse, tmp_path):
    land(tmp_path / "a", D15, page(charge("one", D15)))
    land(tmp_path / "a", D16, page(charge("two", D16)))
    run(loads.STRIPE, tmp_path / "a", warehouse, D15, D16, "r1")
    land(tmp_path / "b", D16, page(charge("three", D16)))
    log = run(loads.STRIPE, tmp_path / "b", warehouse, D16, D16, "r1")
    assert log[D16].rows_loaded == 1
    ids = {r.charge_id for r in warehouse.read("raw.stripe_charges").collect()}
    assert ids == {"one", "three"}


def test_days_never_landed_stay_gaps(warehouse, tmp_path):
    land(tmp_path, D15, page(charge("one", D15)))
    land(tmp_path, D16, page())
    log = run(loads.STRIPE, tmp_path, warehouse, D15, D17)
    assert [log[d].status for d in (D15, D16, D17)] == ["loaded", "skipped", "missing"]
    days = calendar_days(warehouse.spark, D15, D17)
    gaps = missing_days(days, warehouse.run_log(), "stripe_charges").collect()
    assert [r.partition_date for r in gaps] == [D17]


def test_a_failed_audit_leaves_the_table_as_it_was(warehouse):
    for name, table, day, key in (
        ("staging.stripe_charges", "stripe_charges", "charge_date", "charge_id"),
        ("staging.sheet_programs", "google_sheets_programs", "partition_date", "program_id"),
    ):
        built, good = model(name), one_raw_row(warehouse.spark, table)
        loads.load_partitions(good, warehouse, table, day)
        run_model(warehouse, built, D15, D15)
        before = sorted(map(str, warehouse.read(name).collect()))
        assert len(before) == 1
        bad = good.withColumn(key, F.lit(None).cast("string"))
        loads.load_partitions(bad, warehouse, table, day)
        with pytest.raises(AuditError):
            run_model(warehouse, built, D15, D15)
        assert sorted(map(str, warehouse.read(name).collect())) == before


def one_raw_row(spark, table):
    values = {"date": D15, "timestamp": RUN_TIME, "bigint": 1, "double": 1.0, "string": "1"}
    row = tuple(
        "true" if f.name == "is_active" else values.get(f.dataType.simpleString(), Decimal(1))
        for f in RAW[table].fields
    )
    return spark.createDataFrame([row], RAW[table])


def test_ingest_only_the_asked_days(warehouse, tmp_path):
    land(tmp_path, D15, page(charge("ch_1", D15)))
    land(tmp_path, D16, page(charge("ch_2", D16)))
    run(loads.STRIPE, tmp_path, warehouse, D16, D16)
    assert [r.charge_id for r in warehouse.read("raw.stripe_charges").collect()] == ["ch_2"]


def test_ingest_again_replaces_the_day_and_keeps_the_lake(warehouse, tmp_path):
    land(tmp_path / "a", D15, page(charge("ch_1", D15), charge("ch_2", D15)))
    land(tmp_path / "a", D16, page(charge("ch_9", D16)))
    run(loads.STRIPE, tmp_path / "a", warehouse, D15, D16, "r1")
    land(tmp_path / "b", D15, page(charge("ch_3", D15)))
    for _ in range(2):
        run(loads.STRIPE, tmp_path / "b", warehouse, D15, D15, "r2")
    ids = {r.charge_id for r in warehouse.read("raw.stripe_charges").collect()}
    assert ids == {"ch_3", "ch_9"}
    assert loads.read_lake_run(warehouse, "stripe_charges", "r1").count() == 3
    assert loads.read_lake_run(warehouse, "stripe_charges", "r2").count() == 1


def test_zero_rows_keep_the_old_partition(warehouse, tmp_path):
    land(tmp_path / "a", D15, page(charge("ch_1", D15)))
    run(loads.STRIPE, tmp_path / "a", warehouse, D15, D15, "r1")
    land(tmp_path / "b", D15, page())
    log = run(loads.STRIPE, tmp_path / "b", warehouse, D15, D15, "r2")
    assert (log[D15].status, log[D15].uri) == ("skipped", None)
    assert warehouse.read("raw.stripe_charges").count() == 1


def test_missing_page_fails_before_anything_is_written(warehouse, tmp_path):
    land(tmp_path, D15, page(charge("ch_2", D15), after="ch_1"))
    with pytest.raises(loads.IncompletePages, match="2024-01-15"):
        run(loads.STRIPE, tmp_path, warehouse, D15, D15)
    assert list_days(warehouse.spark, warehouse.path("raw.stripe_charges"), "charge_date") == []


def test_bad_record_fails_the_run(warehouse, tmp_path):
    land(tmp_path, D15, insight(D15))
    land(tmp_path, D16, insight(D16, clicks="many"))
    with pytest.raises(Exception, match="Failed to parse facebook_ads: clicks"):
        run(loads.FACEBOOK_ADS, tmp_path, warehouse, D15, D16)
    assert list_days(warehouse.spark, warehouse.path("raw.facebook_ads"), "date") == []


def test_bad_record_can_fail_its_day_only(warehouse, tmp_path):
    land(tmp_path, D15, insight(D15))
    land(tmp_path, D16, insight(D16), insight(D16, clicks="many"))
    log = run(
        loads.FACEBOOK_ADS, tmp_path, warehouse, D15, D16, on_bad_record=loads.FAIL_DAY
    )
    assert {d: r.status for d, r in log.items()} == {D15: "loaded", D16: "failed"}
    assert [r.date for r in warehouse.read("raw.facebook_ads").collect()] == [D15]
    gaps = missing_days(
        calendar_days(warehouse.spark, D15, D17), warehouse.run_log(), "facebook_ads"
    )
    assert sorted(r[0] for r in gaps.collect()) == [D16, D17]


def ads_row(day, clicks):
    metrics = {"clicks": clicks, "impressions": "100", "costMicros": "6500000", "conversions": "2.0"}
    return {"segments": {"date": day.isoformat()}, "metrics": metrics}


def test_accounts_of_a_day_stand_side_by_side(warehouse, tmp_path):
    for name, clicks in (("a", "1"), ("b", "2"), ("c", "9")):
        land(tmp_path / name, D15, ads_row(D15, clicks))
        land(tmp_path / name, D16, ads_row(D16, clicks))
    one, other = loads.google_ads_account("0012"), loads.google_ads_account("34")
    run(one, tmp_path / "a", warehouse, D15, D16)
    run(other, tmp_path / "b", warehouse, D15, D16)  # under the same run id
    run(one, tmp_path / "c", warehouse, D16, D16, "r2")
    rows = warehouse.read("raw.google_ads").collect()
    assert {(r.date, r.customer_id, r.clicks) for r in rows} == {
        (D15, "0012", 1), (D15, "34", 2), (D16, "0012", 9), (D16, "34", 2),
    }
    lake = loads.read_lake_run(warehouse, "google_ads", "r1").collect()
    assert {(r.date, r.customer_id) for r in lake} == {(d, c) for d in (D15, D16) for c in ("0012", "34")}
    run_model(warehouse, model("staging.google_ads_performance"), D15, D16)
    assert warehouse.read("staging.google_ads_performance").count() == 4


def test_a_failed_retry_leaves_what_the_run_had_kept(warehouse, tmp_path):
    land(tmp_path / "a", D15, insight(D15), insight(D15, "6"))
    land(tmp_path / "a", D16, insight(D16))
    run(loads.FACEBOOK_ADS, tmp_path / "a", warehouse, D15, D16)
    land(tmp_path / "b", D15, insight(D15, "7"))
    land(tmp_path / "b", D16, insight(D16, "8"), insight(D16, "many"))
    with pytest.raises(loads.BadRecord, match="clicks in .*many"):
        run(loads.FACEBOOK_ADS, tmp_path / "b", warehouse, D15, D16)

    def kept():
        lake = loads.read_lake_run(warehouse, "facebook_ads", "r1")
        raw = warehouse.read("raw.facebook_ads")
        return [sorted((r.date, r.clicks) for r in frame.collect()) for frame in (lake, raw)]

    before = [(D15, 5), (D15, 6), (D16, 5)]
    assert kept() == [before, before]
    # The day without bad records goes on; the other one keeps its earlier rows.
    run(loads.FACEBOOK_ADS, tmp_path / "b", warehouse, D15, D16, on_bad_record=loads.FAIL_DAY)
    after = [(D15, 7), (D16, 5)]
    assert kept() == [after, after]
    days = loads.read_lake_run(warehouse, "facebook_ads", "r1", D16, D16)
    assert [(r.date, r.clicks) for r in days.collect()] == [(D16, 5)]


def test_a_run_that_dies_before_its_commit_changes_nothing(warehouse, tmp_path, monkeypatch):
    land(tmp_path / "a", D15, insight(D15))
    run(loads.FACEBOOK_ADS, tmp_path / "a", warehouse, D15, D15)
    land(tmp_path / "b", D15, insight(D15, "7"))
    with monkeypatch.context() as patch:
        patch.setattr(attempts, "commit", lambda *args: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            run(loads.FACEBOOK_ADS, tmp_path / "b", warehouse, D15, D15)
    for frame in (loads.read_lake_run(warehouse, "facebook_ads", "r1"), warehouse.read("raw.facebook_ads")):
        assert [r.clicks for r in frame.collect()] == [5]
    assert warehouse.run_log().count() == 1


def json_scans(spark):
    store = spark._jsparkSession.sharedState().statusStore()
    found = store.executionsList()
    return sum("Scan json" in found.apply(n).physicalPlanDescription() for n in range(found.size()))


@pytest.mark.parametrize("policy", [loads.FAIL_RUN, loads.FAIL_DAY])
def test_documents_are_read_once(warehouse, tmp_path, policy):
    land(tmp_path, D15, page(charge("ch_1", D15), charge("ch_2", D15), more=True))
    land(tmp_path, D15, page(after="ch_2"))
    land(tmp_path, D16, page(charge("ch_3", D16), *([charge(None, D16)] if policy == loads.FAIL_DAY else [])))
    before = json_scans(warehouse.spark)
    log = run(loads.STRIPE, tmp_path, warehouse, D15, D17, on_bad_record=policy)
    assert json_scans(warehouse.spark) == before + 1
    assert [log[d].rows_loaded for d in (D15, D16, D17)] == [2, policy == loads.FAIL_RUN, 0]
    if policy == loads.FAIL_DAY:
        assert log[D16].status == "failed"
        (attempt,) = attempts.committed(warehouse.spark, warehouse.lake_path("stripe_charges"), "r1")
        refused = loads.read_rejects(warehouse, "stripe_charges", "r1", attempt.name).collect()
        assert [(r.partition_date, r.parse_error) for r in refused] == [(D16, "charge_id")]
        assert '"amount":"1000"' in refused[0].record and "page_link" not in refused[0].record


def test_days_seen_over_more_days_than_bits(spark):
    start, end = date(2024, 1, 1), date(2024, 12, 31)
    days = [date(2024, 1, 1), date(2024, 2, 29), date(2024, 3, 1), date(2024, 12, 31)]
    seen = loads.DaysSeen(start, end)
    frame = spark.createDataFrame([(d,) for d in days * 3], "landed_date date")
    seen.watch(frame).write.format("noop").mode("overwrite").save()
    assert seen.days() == days


def test_sheet_snapshots(warehouse, tmp_path):
    def sheet(*rows):
        header = ["program_id", "program_name", "program_code", "duration_weeks"]
        header += ["max_enrollment", "is_active"]
        return {"sheet": "programs", "values": [header, *rows]}

    old = ["p1", "Old", "O", "4", "10", "TRUE"]
    new = ["p1", "New", "N", "4", "10", "FALSE"]
    land(tmp_path, D15, sheet(old))
    land(tmp_path, D16, sheet(new, ["p2", "More", "M", "4", "10", "TRUE"]))
    log = run(loads.sheet("programs"), tmp_path, warehouse, D15, D16)
    assert log[D16].sheet_name == "programs"
    # Only the last landed sheet counts.
    names = {r.program_name for r in warehouse.read("raw.google_sheets_programs").collect()}
    assert names == {"New", "More"}
    run_model(warehouse, model("staging.sheet_programs"), D15, D16)
    built = warehouse.read("staging.sheet_programs")
    assert {(r.program_id, r.is_active) for r in built.collect()} == {
        ("p1", False),
        ("p2", True),
    }


def inventory_rows(spark, *rows):
    names = RAW["google_sheets_inventory"].fieldNames()
    values = [
        tuple({"sku_id": sku, "snapshot_date": day, "partition_date": landed}.get(n) for n in names)
        for sku, day, landed in rows
    ]
    return spark.createDataFrame(values, RAW["google_sheets_inventory"])


def test_inventory_takes_the_last_landing_of_each_snapshot(warehouse):
    rows = [("a", "2024-01-15", D15), ("b", "2024-01-15", D16), ("c", "2024-01-16", D16)]
    # A plan for the 20th that was landed before that day, and a text that is no date.
    rows += [("d", "2024-01-20", D15), ("e", "soon", D15), ("f", None, D15)]
    frame = inventory_rows(warehouse.spark, *rows)
    loads.load_partitions(frame, warehouse, "google_sheets_inventory", "partition_date")

    def found(*days):
        read = warehouse.read_whole("raw.google_sheets_inventory", *days)
        return {r.sku_id for r in read.collect()}, read.inputFiles()

    assert {r.sku_id for r in warehouse.read("raw.google_sheets_inventory").collect()} == {*"bcdef"}
    late = date(2024, 1, 20)
    skus, read = found(late, late)
    # What can't be read as a date is for the model to refuse.
    assert skus == {*"def"} and all("partition_date=2024-01-15" in name for name in read)
    assert found(D16, D16)[0] == {*"cef"}
    # The landing of the 16th comes again without the 15th, which is back to the one before.
    again = inventory_rows(warehouse.spark, ("g", "2024-01-16", D16))
    loads.load_partitions(again, warehouse, "google_sheets_inventory", "partition_date")
    assert {r.sku_id for r in warehouse.read("raw.google_sheets_inventory").collect()} == {*"adefg"}
    assert found(date(2025, 1, 1), date(2025, 1, 1))[0] == {*"ef"}


def test_the_log_has_one_row_per_run_and_day_and_one_file_per_month(warehouse, tmp_path):
    spark, end = warehouse.spark, date(2024, 2, 2)
    land(tmp_path, D15, insight(D15))
    for n in range(3):
        run(loads.FACEBOOK_ADS, tmp_path, warehouse, D15, end, "r1")
        run(loads.FACEBOOK_ADS, tmp_path, warehouse, D15, D16, f"n{n}")
    log = warehouse.run_log()
    assert log.count() == log.select("run_id", "partition_date").distinct().count() == 19 + 6
    assert {(r.partition_date, r.status) for r in log.where("run_id = 'n2'").collect()} == {(D15, "loaded"), (D16, "missing")}
    assert len(log.inputFiles()) == 2
    assert warehouse.run_log("stripe_charges").count() == 0


def test_a_log_published_by_another_run_meanwhile(warehouse, tmp_path, monkeypatch):
    land(tmp_path, D15, insight(D15))
    publish, raced = snapshots.publish, []

    def race(spark, path, *rest):
        if "run_log" in path and not raced:
            raced.append(path)
            run(loads.FACEBOOK_ADS, tmp_path, warehouse, D16, D16, "other")
        return publish(spark, path, *rest)

    monkeypatch.setattr(snapshots, "publish", race)
    run(loads.FACEBOOK_ADS, tmp_path, warehouse, D15, D15, "r1")
    assert {(r.run_id, r.partition_date) for r in warehouse.run_log().collect()} == {("r1", D15), ("other", D16)}


@pytest.mark.parametrize("columns", [("a", "b"), ("b", "a"), ("name", "b")])
def test_row_groups_are_skipped_on_every_cluster_column(warehouse, columns):
    spark, path = warehouse.spark, f"{warehouse.root}/curve"
    rows = spark.range(40_000, numPartitions=1).select(
        F.lit(D15).alias("date"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("int").alias("a"),
        F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1000)).alias("b"),
        F.concat(F.lit("n"), F.lpad(F.pmod(F.xxhash64("id"), F.lit(1000)).cast("string"), 3, "0")).alias("name"),
        "id",
    )
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "625")
    try:
        write_days(rows, path, ["date"], cluster_columns=columns)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    read = spark.read.parquet(path)
    assert read.count() == 40_000
    spans = read.groupBy(F.input_file_name()).agg(
        *[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns]
    ).collect()
    assert len(spans) == 64
    for column in columns:
        value = "n500" if column == "name" else 500
        open_ = [s for s in spans if s[column].lo <= value <= s[column].hi]
        assert len(open_) <= 16, column


def test_rows_to_cluster_may_be_null_or_none(warehouse):
    spark = warehouse.spark
    frame = spark.createDataFrame([(D15, None, 1), (D15, "x", None), (D15, None, None)], "date date, a string, b int")
    for n, rows in enumerate((frame, frame.where("false"))):
        path = f"{warehouse.root}/t{n}"
        write_days(rows, path, ["date"], cluster_columns=("a", "b"))
    assert spark.read.parquet(f"{warehouse.root}/t0").count() == 3
    with pytest.raises(TypeError, match="clustered"):
        write_days(frame.withColumn("c", F.array("b")), path, ["date"], cluster_columns=("a", "c"))


def fb_raw(spark, *rows):
    names = RAW["facebook_ads"].fieldNames()
    values = [
        tuple({"date": d, "campaign_id": c, "clicks": n}.get(name) for name in names)
        for d, c, n in rows
    ]
    return spark.createDataFrame(values, RAW["facebook_ads"])


def test_rebuild_clears_days_that_became_empty(warehouse):
    spark, performance = warehouse.spark, model("staging.facebook_ads_performance")
    loads.load_partitions(
        fb_raw(spark, (D15, "a", 1), (D16, "b", 2), (D17, "c", 3)), warehouse, "facebook_ads"
    )
    assert run_model(warehouse, performance, D15, D17) == 3
    files.delete(spark, f"{warehouse.path('raw.facebook_ads')}/date={D16}")
    assert run_model(warehouse, performance, D15, D16) == 1
    path = warehouse.path(performance.name)
    assert snapshots.current(spark, path).days() == [D15, D17]
    assert {r.campaign_id for r in warehouse.read(performance.name).collect()} == {"a", "c"}
    found = warehouse.read_range(performance.name, "date", D17, D17)
    assert [r.campaign_id for r in found.collect()] == ["c"]
    assert all("date=2024-01-15" not in name for name in found.inputFiles())


class Killed(Exception):
    pass


@pytest.mark.parametrize("name", ["staging.facebook_ads_performance", "staging.sheet_programs"])
@pytest.mark.parametrize("step", ["rows", "count", "draft", "rename", "sweep"])
def test_a_killed_rebuild_leaves_the_old_or_the_new_table(warehouse, monkeypatch, name, step):
    spark, built = warehouse.spark, model(name)
    table, day = ("facebook_ads", "date") if "facebook" in name else ("google_sheets_programs", "partition_date")
    row = one_raw_row(spark, table)
    if table == "facebook_ads":
        # The rebuild empties one day and fills another.
        old = row.unionByName(row.withColumn("date", F.lit(D16)))
        new = row.withColumn("campaign_id", F.lit("new"))
    else:
        old, new = row, row.withColumn("program_name", F.lit("new"))
    loads.load_partitions(old, warehouse, table, day)
    run_model(warehouse, built, D15, D17)
    before = sorted(map(str, warehouse.read(name).collect()))
    files.delete(spark, warehouse.path(f"raw.{table}"))
    loads.load_partitions(new, warehouse, table, day)

    def die(*args, **kwargs):
        raise Killed

    def die_after_the_draft(spark, path, text):
        files.ensure_folder(spark, path.rsplit("/", 1)[0])
        files.create_text(spark, f"{path}.x.draft", text)
        raise Killed

    with monkeypatch.context() as patch:
        if step == "rows":
            patch.setattr(runner, "write_days" if table == "facebook_ads" else "written", die)
        elif step == "count":
            patch.setattr(snapshots, "with_range", die)
            patch.setattr(snapshots, "publish", die)
        elif step == "draft":
            patch.setattr(snapshots, "publish", lambda spark, path, *rest: die_after_the_draft(spark, f"{path}/_manifest/00000002.json", "{"))
        elif step == "rename":
            patch.setattr(snapshots.files, "create_text", lambda *args: die())
        else:
            patch.setattr(snapshots, "sweep", die)
        with pytest.raises(Killed):
            run_model(warehouse, built, D15, D17)
    after = sorted(map(str, warehouse.read(name).collect()))
    if step == "sweep":
        assert len(after) == 1 and "new" in after[0]
    else:
        assert after == before
    # The next run goes on from there, and what was left behind goes.
    assert run_model(warehouse, built, D15, D17) == 1
    (final,) = map(str, warehouse.read(name).collect())
    assert "new" in final
    left = [n for n in files.names(spark, warehouse.path(name)) if n.startswith("build=")]
    assert len(left) <= 2


def test_a_reader_of_the_table_before_still_finds_its_files(warehouse):
    performance = model("staging.facebook_ads_performance")
    for n in range(4):
        loads.load_partitions(fb_raw(warehouse.spark, (D15, f"c{n}", n)), warehouse, "facebook_ads")
        if n:
            reading = warehouse.read(performance.name)
        run_model(warehouse, performance, D15, D15)
        if n:
            assert [r.campaign_id for r in reading.collect()] == [f"c{n - 1}"]
    path = warehouse.path(performance.name)
    builds = [name for name in files.names(warehouse.spark, path) if name.startswith("build=")]
    assert len(builds) == 2


def test_a_table_published_by_another_job_meanwhile(warehouse):
    spark, path = warehouse.spark, f"{warehouse.root}/t"
    schema = RAW["facebook_ads"]
    before = snapshots.current(spark, path)
    snapshots.publish(spark, path, before, {}, schema, "date")
    with pytest.raises(snapshots.Overtaken):
        snapshots.publish(spark, path, before, {}, schema, "date")
    assert snapshots.read(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, f"{path}/never")


def test_range_read_lists_only_its_days(warehouse):
    rows = fb_raw(warehouse.spark, (D15, "a", 1), (D16, "b", 2), (D17, "c", 3))
    loads.load_partitions(rows, warehouse, "facebook_ads")
    found = warehouse.read_range("raw.facebook_ads", "date", D16, D17)
    assert all("date=2024-01-15" not in name for name in found.inputFiles())
    assert {(r.date, r.campaign_id) for r in found.collect()} == {(D16, "b"), (D17, "c")}
    later = date(2025, 1, 1)
    empty = warehouse.read_range("raw.facebook_ads", "date", later, later)
    assert empty.count() == 0 and empty.columns == found.columns


def test_session_sizing():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert sized_for(1 << 30)[key] == "200"
    assert sized_for(1 << 40)[key] == "8192"
    assert sized_for(1 << 50)[key] == str(1 << 23)


def test_rows_written_are_reported(warehouse):
    rows = fb_raw(warehouse.spark, (D15, "a", 1), (D15, "b", 2))
    path = f"{warehouse.root}/t"
    assert write_days(rows, path, ["date"], key_column="reach") == Written(2, 2)
    assert write_days(rows.where("false"), path, ["date"]) == Written(0, 0)


def test_clustered_files_are_sorted(warehouse):
    spark = warehouse.spark
    frame = spark.range(1000).select(
        F.lit(D15).alias("date"), ((F.col("id") * 7919) % 1000).alias("campaign")
    )
    path = f"{warehouse.root}/clustered"
    write_days(frame, path, ["date"], cluster_columns=("campaign",))
    values = [r.campaign for r in spark.read.parquet(path).coalesce(1).collect()]
    assert values == sorted(values)


def test_audit(spark):
    frame = spark.createDataFrame([("a", 1), (None, 2)], "k string, n int")
    with pytest.raises(AuditError, match="t: null k"):
        assert_no_nulls(frame, "k", "t")
    assert_no_nulls(frame, "n", "t")
    assert_no_nulls(frame.where("false"), "k", "t")


def test_repeated_keys(spark):
    frame = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [tuple(r) for r in repeated_keys(frame, ("k",)).collect()] == [(1, 2)]


def test_null_key_fails_a_model_run(warehouse):
    rows = [
        (None, D15, *[None] * 11),
    ]
    frame = warehouse.spark.createDataFrame(rows, RAW["stripe_charges"])
    loads.load_partitions(frame, warehouse, "stripe_charges", "charge_date")
    with pytest.raises(AuditError, match="charge_id"):
        run_model(warehouse, model("staging.stripe_charges"), D15, D15)


def test_calendar(spark):
    days = [r[0] for r in calendar_days(spark, D15, D17).collect()]
    assert days == [D15, D16, D17]
    assert calendar_days(spark, D17, D15).count() == 0


def test_loaded_at_is_one_utc_instant_and_last(spark):
    eastern = datetime.fromisoformat("2024-02-01T01:00:00.000007-05:00")
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    stamped = loads.add_loaded_at(frame, eastern)
    assert stamped.columns == ["id", "name", "loaded_at"]
    micros = stamped.select(F.unix_micros("loaded_at")).distinct().collect()
    assert [r[0] for r in micros] == [1706767200000007]
    empty = loads.add_loaded_at(frame.where("false"), eastern)
    assert empty.columns[-1] == "loaded_at" and empty.count() == 0


def test_new_york_day_follows_summer_time(spark):
    texts = ["2024-01-15 04:59:59", "2024-01-15 05:00:00"]
    texts += ["2024-07-15 03:59:59", "2024-07-15 04:00:00"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    days = frame.select(new_york_day(F.col("t").cast("timestamp_ntz"))).collect()
    assert [r[0] for r in days] == [
        date(2024, 1, 14),
        D15,
        date(2024, 7, 14),
        date(2024, 7, 15),
    ]


def test_whole_months():
    assert whole_months(D15, date(2024, 2, 3)) == (date(2024, 1, 1), date(2024, 2, 29))


def test_every_model_from_landed_files(warehouse, tmp_path):
    """Six sources, three days, all models; then one more day of revenue."""

    def sheet(name, header, *rows):
        return {"sheet": name, "values": [header.split(), *rows]}

    report = {
        "rows": [
            {
                "dimension_values": [
                    {"value": v} for v in ("20240115", "google", "cpc", "Japan")
                ],
                "metric_values": [{"value": v} for v in ("4", "9", "0.5", "1.0")],
            }
        ]
    }
    ad = {
        "segments": {"date": "2024-01-15"},
        "metrics": {
            "clicks": "10",
            "impressions": "100",
            "costMicros": "6500000",
            "conversions": "2.0",
        },
    }
    payment = {
        "transaction_info": {
            "transaction_id": "t1",
            "transaction_initiation_date": "2024-01-16T08:00:00+0000",
            "transaction_amount": {"value": "20.00", "currency_code": "USD"},
            "transaction_status": "S",
            "transaction_subject": "Barber kit",
            "fee_amount": {"value": "-1.00"},
            "transaction_net_amount": {"value": "19.00"},
        }
    }
    charged = {**charge("ch_1", D15), "description": "BARBER program"}
    land(tmp_path / "stripe", D15, page(charged))
    land(tmp_path / "paypal", D16, {"page": 1, "total_pages": 1, "transaction_details": [payment]})
    land(tmp_path / "fb", D15, insight(D15))
    land(tmp_path / "ga", D15, report)
    land(tmp_path / "ads", D15, ad)
    students = sheet(
        "students",
        "student_id first_name last_name email phone program_id enrollment_status "
        "enrolled_at expected_grad_date actual_grad_date",
        ["s1", "A", "B", "e", "p", "p1", "active", "2024-01-15", "2024-07-15", "2024-07-15"],
        ["s2", "A", "B", "e", "p", "p1", "withdrawn", "2024-01-16", "2024-07-15", "2024-07-15"],
    )
    programs = sheet(
        "programs",
        "program_id program_name program_code duration_weeks max_enrollment is_active",
        ["p1", "Barber", "B", "4", "10", "TRUE"],
    )
    stock = sheet(
        "inventory",
        "sku_id sku_name program_id quantity_on_hand reorder_threshold reorder_quantity "
        "unit_cost_usd units_per_student snapshot_date",
        ["k1", "Comb", "p1", "20", "10", "5", "1.50", "2", "2024-01-16"],
    )
    land(tmp_path / "sheets", D16, students, programs, stock)
    sources = {
        "stripe": loads.STRIPE,
        "paypal": loads.PAYPAL,
        "fb": loads.FACEBOOK_ADS,
        "ga": loads.GOOGLE_ANALYTICS,
        "ads": loads.google_ads_account("77"),
    }
    for folder, source in sources.items():
        run(source, tmp_path / folder, warehouse, D15, D17)
    for name in ("students", "programs", "inventory"):
        run(loads.sheet(name), tmp_path / "sheets", warehouse, D15, D17)
    written = run_all_models(warehouse, D15, D17)
    assert set(written) == {m.name for m in MODELS}

    revenue = warehouse.read("marts.revenue_by_program").collect()
    assert {(r.payment_source, r.program_id, r.net_revenue) for r in revenue} == {
        ("stripe", "p1", Decimal("9.7")),
        ("paypal", "p1", Decimal("19")),
    }
    assert {r.month for r in revenue} == {date(2024, 1, 1)}
    by_day = {r.date: r for r in warehouse.read("marts.ad_attribution").collect()}
    assert by_day[D15].cost_per_ad_conversion_usd == 3.25
    assert by_day[D15].total_paid_sessions == 4
    assert by_day[D16].total_spend_usd == 0
    (level,) = warehouse.read("marts.stock_levels").collect()
    assert (level.stock_status, level.days_of_stock_remaining) == (
        "reorder_soon",
        Decimal("10.0"),
    )
    again = run_model(
        warehouse, model("marts.revenue_by_program"), D17, D17 + timedelta(days=1)
    )
    assert again == 2
    assert warehouse.read("marts.revenue_by_program").count() == 2
