"""Typed loading, sinks and views."""

from __future__ import annotations

from datetime import date

import pytest

from loomcart.sources import sinks, star
from loomcart.sources.schemas import SCHEMAS
from tests.small_star import make_star


@pytest.fixture
def tiny(spark):
    day = date(2024, 1, 1)
    return make_star(
        spark, [(1, day, "control")], [(1, 1, day, "Completed", True)], [(1, 1, 2, "5.25", "10.50")], [(1, "a", 3, 5.25)]
    )


def test_csv_star_round_trip(spark, tiny, tmp_path):
    for table, df in tiny.tables().items():
        sinks.write_csv(df, f"{tmp_path}/{table}.csv")
    back = star.read_csv_star(spark, str(tmp_path))
    for table, df in tiny.tables().items():
        loaded = back.tables()[table]
        assert [f.dataType for f in loaded.schema] == [f.dataType for f in SCHEMAS[table]]
        assert loaded.collect() == df.select(SCHEMAS[table].names).collect()


def test_csv_with_a_wrong_value_fails(spark, tmp_path):
    (tmp_path / "t.csv").write_text("date,day,month,month_name,quarter,year,day_of_week,is_weekend\nnot-a-date,1,1,Jan,1,2024,Monday,false\n")
    with pytest.raises(Exception, match="MALFORMED|cannot|parse"):
        star.read_csv_table(spark, f"{tmp_path}/t.csv", "dim_date").collect()


def test_parquet_star_round_trip_and_views(spark, tiny, tmp_path):
    star.write_parquet_star(tiny, str(tmp_path))
    back = star.read_parquet_star(spark, str(tmp_path))
    assert {r["table_name"]: r["loaded_rows"] for r in star.load_report(back).collect()} == {t: 1 for t in SCHEMAS}
    star.register(back)
    total = spark.sql("SELECT sum(line_total) FROM fact_order_items JOIN fact_orders USING (order_id) WHERE in_ab_test").first()[0]
    assert float(total) == 10.5


def test_conform_names_the_missing_column(spark):
    with pytest.raises(ValueError, match="unit_price"):
        star.conform(spark.createDataFrame([(1,)], "order_item_id int"), "fact_order_items")


def test_metrics_sink(spark, tmp_path):
    sinks.write_metrics(sinks.metrics_frame(spark, "churn", {"auc_roc": 0.5, "rows": 3}), f"{tmp_path}/m")
    assert {(r["metric"], r["value"]) for r in spark.read.json(f"{tmp_path}/m").collect()} == {("auc_roc", 0.5), ("rows", 3.0)}


def test_lines_do_not_need_the_price(spark, tiny):
    assert "unit_price" not in tiny.lines.columns and "unit_price" in tiny.order_items.columns
