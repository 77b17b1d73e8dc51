"""Bitmaps, stored tables, checked loads, roll-ups and the shared customer history."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loomcart import catalog
from loomcart.operators import features, rollup
from loomcart.operators.bitmaps import bitmaps, distinct_count, merged
from loomcart.operators.order_values import completed, order_values
from loomcart.plans import cohort
from loomcart.sources import star as stars
from loomcart.sources.checked import read_csv_checked
from loomcart.sources.tpch import read_star

FOLDER = "/root/testdata/sf0.001"


def test_bitmaps_count_any_grouping(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.randrange(3), rng.choice([None, 7, rng.randrange(200_000)])) for _ in range(5000)]
    maps = bitmaps(spark.createDataFrame(rows, "x string, y int, k long").repartition(4), ["x", "y"], "k")
    for by in (["x", "y"], ["x"], ["y"], []):
        got = {tuple(r[c] for c in by): r["n"] for r in distinct_count(maps, by, "n").collect()}
        places = [("x", "y").index(c) for c in by]
        want: dict = {}
        for row in rows:
            want.setdefault(tuple(row[p] for p in places), set()).add(row[2])
        assert got == {k: len(v - {None}) for k, v in want.items()}
    assert merged(maps, ["x"]).count() <= 2 * (200_000 // 32768 + 1)


def test_heatmap_and_total_from_one_table(spark):
    star = read_star(spark, FOLDER)
    maps = cohort.activity_bitmaps(star)
    assert sorted(cohort.cohort_heatmap(star, maps).collect()) == sorted(cohort.cohort_heatmap(star).collect())
    total = cohort.active_customers(star, maps).where("acquisition_channel IS NULL").first()["active_customers"]
    assert total == cohort.cohort_activity(star).select("customer_id").distinct().count()


@pytest.fixture
def by_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_order_values_on_stored_tables_do_not_shuffle(spark, tmp_path, by_shuffle):
    star = read_star(spark, FOLDER)
    stars.store_star(star, str(tmp_path), prefix="kept_", buckets=4)
    try:
        kept = stars.stored_star(spark, "kept_")
        found = order_values(completed(kept.orders), kept.lines)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        want = order_values(completed(star.orders), star.lines)
        columns = ["order_id", "customer_id", "order_date", "order_value"]
        assert sorted(found.select(columns).collect()) == sorted(want.select(columns).collect())
        assert spark.sql("SELECT count(*) FROM kept_fact_orders").first()[0] == star.orders.count()
    finally:
        stars.drop_star(spark, "kept_")
    assert not spark.catalog.tableExists("kept_fact_orders")


def test_checked_load(spark, tmp_path):
    header = "order_item_id,order_id,product_id,quantity,unit_price,line_total\n"
    (tmp_path / "a.csv").write_text(header + '1,1,1,2,1.50,3.00\n2,1,x,2,1.50,3.00\n3,1,1,2,1.50\n,1,1,2,1.50,3.00\n4,1,1,2.5,1.505,3\n5,,,,,\n')
    (tmp_path / "b.csv").write_text(header + "6,1,1,2,1.50,3.00,9\n7,1,1,99999999999,1e3,3.00\n")
    load = read_csv_checked(spark, str(tmp_path), "fact_order_items")
    assert sorted(r["order_item_id"] for r in load.good.collect()) == [1, 5]
    rejects = {r["line"]: (r["file"].rpartition("/")[2], r["reasons"]) for r in load.rejects.collect()}
    assert rejects == {
        "2,1,x,2,1.50,3.00": ("a.csv", ["product_id: bigint"]),
        "3,1,1,2,1.50": ("a.csv", ["fields"]),
        ",1,1,2,1.50,3.00": ("a.csv", ["order_item_id: missing"]),
        "4,1,1,2.5,1.505,3": ("a.csv", ["quantity: int", "unit_price: decimal(10,2)"]),
        "6,1,1,2,1.50,3.00,9": ("b.csv", ["fields"]),
        "7,1,1,99999999999,1e3,3.00": ("b.csv", ["quantity: int"]),
    }
    assert tuple(load.counts().first()) == (2, 6)
    assert [f.dataType for f in load.good.schema] == [f.dataType for f in stars.SCHEMAS["fact_order_items"]]


def test_checked_load_of_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_item_id,order_id,product_id,quantity,unit_price,line_total\n")
    assert tuple(read_csv_checked(spark, str(tmp_path), "fact_order_items").counts().first()) == (0, 0)


def test_rollup_is_idempotent_and_follows_corrections(spark, tmp_path):
    folder = str(tmp_path / "rollup")
    start = date(2024, 1, 10)
    rows = {i: (i, start + timedelta(days=9 * i), Decimal(i)) for i in range(1, 30)}

    def load(ids, version, change=lambda row: row):
        batch = spark.createDataFrame([change(rows[i]) for i in ids], "order_id long, order_date date, order_value decimal(12,2)")
        rollup.load_batch(batch, folder, version)

    def totals():
        return {r["month"]: r["revenue"] for r in rollup.monthly_totals(spark, folder).collect()}

    def want(current):
        out: dict = {}
        for _, day, value in current:
            out[day.replace(day=1)] = out.get(day.replace(day=1), Decimal(0)) + value
        return out

    load(range(1, 20), 1)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "rollup" / "months").rglob("*.parquet")}
    load(range(20, 30), 2)
    assert totals() == want(rows.values())
    kept = [p for p in files if p.exists() and p.stat().st_mtime_ns == files[p]]
    assert kept and "month=2024-01-01" in str(kept)  # months without a row of the batch are not written again
    load(range(20, 30), 2)
    load(range(1, 20), 1)
    assert totals() == want(rows.values())

    moved = {3: (3, date(2025, 6, 1), Decimal(1000)), 1: (1, date(2025, 6, 2), Decimal(5)), 2: (2, date(2025, 6, 3), Decimal(5))}
    load(moved, 3, lambda row: moved[row[0]])
    current = {**rows, **moved}
    assert totals() == want(current.values()) and date(2024, 1, 1) not in totals()
    load(range(1, 20), 1)  # an older version does not come back
    assert totals() == want(current.values())
    load([1, 2, 3], 4)
    assert totals() == want(rows.values())


def test_both_features_from_one_history(spark):
    star = read_star(spark, FOLDER)
    history = features.customer_history(star).cache()
    assert history.select(F.max(F.size("days"))).first()[0] <= features.LAST_DAY + 1
    for report in (features.clv_features, features.churn_features):
        assert sorted(map(str, report(star, history).collect())) == sorted(map(str, report(star).collect()))
    history.unpersist()


def test_a_customer_with_many_orders_is_summed_by_day_first(spark):
    plan = features.customer_history(read_star(spark, FOLDER))._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    assert "collect_list" in aggregates[0] and "day" in aggregates[1].split("]")[0]


def test_small_dimensions_start_no_job_and_no_unused_join(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    tagged = catalog.ab_tagging(read_star(spark, FOLDER))
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    reading = len(tracker.getJobIdsForGroup("building"))
    spark.sparkContext.setJobGroup("rest", "")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "nation" not in plan
    assert reading <= 3  # schemas of orders, customers and nations
