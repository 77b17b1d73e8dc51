"""One test per decision that changes a value: windows, ties, gaps, zero bases, empty orders."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loomcart.operators import features, quality
from loomcart.operators.calendar import calendar_of
from loomcart.operators.order_values import completed, order_values
from loomcart.operators.tagging import line_totals, tag_orders
from loomcart.plans import abtest, cohort, growth, kpi, rfm, scenario, segment
from tests.small_star import make_star

DONE = "Completed"
SIGNUP = date(2024, 1, 1)
LATE = SIGNUP + timedelta(days=400)  # another customer's signup makes SIGNUP eligible


def rows(df):
    return [r.asDict() for r in df.collect()]


def star_with_days(spark, offsets):
    orders = [(n, 1, SIGNUP + timedelta(days=d), DONE) for n, d in enumerate(offsets)]
    items = [(n, 1, 1, 10, 10) for n, _ in enumerate(offsets)]
    return make_star(spark, [(1, SIGNUP, "control"), (2, LATE, "control")], orders, items)


def test_windows_are_inclusive_and_disjoint(spark):
    star = star_with_days(spark, [-1, 0, 90, 91, 180, 181, 270, 271])
    (clv,) = rows(features.clv_features(star))
    assert (clv["orders_first90"], clv["spend_first90"], clv["spend_next90"]) == (2, 20.0, 20.0)
    (churn,) = rows(features.churn_features(star))
    assert (churn["orders_0_180"], churn["orders_181_270"], churn["churned"]) == (4, 2, 0)


def test_tenure_counts_from_the_latest_signup(spark):
    def eligible(days):
        customers = make_star(spark, [(1, SIGNUP, "control"), (2, SIGNUP + timedelta(days=days), "control")]).customers
        return {r["customer_id"] for r in rows(features.eligible_customers(customers, 181))}

    assert eligible(181) == {1} and eligible(180) == set()


def test_empty_orders_are_dropped_by_reports_and_counted_by_features(spark):
    star = make_star(
        spark,
        [(1, SIGNUP, "control"), (2, LATE, "control")],
        [(1, 1, SIGNUP, DONE), (2, 1, SIGNUP, DONE)],
        [(1, 1, 1, 10, 10)],
    )
    assert order_values(completed(star.orders), star.lines).count() == 1
    assert rows(rfm.rfm_raw(star))[0]["frequency"] == 1
    (clv,) = rows(features.clv_features(star))
    assert (clv["orders_first90"], clv["spend_first90"], clv["avg_order_value_first90"]) == (2, 10.0, 10.0)
    assert rows(kpi.orders_without_items(star)) == [{"order_status": DONE, "orders": 1}]


def test_only_empty_orders_give_zero_not_null(spark):
    star = make_star(spark, [(1, SIGNUP, "control"), (2, LATE, "control")], [(1, 1, SIGNUP, DONE)])
    (clv,) = rows(features.clv_features(star))
    assert (clv["spend_first90"], clv["avg_order_value_first90"]) == (0.0, 0.0)


def test_status_counts_only_completed_but_repeat_rate_counts_all(spark):
    orders = [(1, 1, SIGNUP, DONE), (2, 1, SIGNUP, "Cancelled"), (3, 2, SIGNUP, "Returned")]
    star = make_star(
        spark, [(1, SIGNUP, "control"), (2, SIGNUP, "control"), (3, SIGNUP, "control")], orders, [(n, 1, 2, 5, 8) for n in (1, 2, 3)]
    )
    assert rows(kpi.repeat_purchase_rate(star)) == [
        {"repeat_customers": 1, "total_customers": 3, "repeat_purchase_rate": 0.333333}
    ]
    (cards,) = rows(kpi.kpi_cards(star))
    assert cards == {
        "total_revenue": 30.0,
        "completed_revenue": 10.0,
        "total_orders": 3,
        "average_order_value": 3.3333,
        "total_customers": 3,
    }


def test_recency_counts_from_the_last_completed_order_with_items(spark):
    star = make_star(
        spark,
        [],
        [(1, 1, date(2024, 1, 1), DONE), (2, 2, date(2024, 1, 11), DONE), (3, 1, date(2024, 3, 1), DONE), (4, 1, date(2024, 4, 1), "Returned")],
        [(1, 1, 1, 1, 1), (2, 1, 1, 1, 1), (4, 1, 1, 1, 1)],
    )
    assert {r["customer_id"]: r["recency_days"] for r in rows(rfm.rfm_raw(star))} == {1: 10, 2: 0}
    assert {r["recency_days"] for r in rows(rfm.rfm_raw(star, as_of=date(2024, 1, 21)))} == {20, 10}


@pytest.mark.parametrize(
    "scores,name",
    [
        ((4, 4, 4), "Champions"),
        ((5, 4, 3), "Loyal Customers"),
        ((3, 3, 1), "Loyal Customers"),
        ((4, 2, 5), "New Customers"),
        ((2, 3, 5), "At Risk"),
        ((2, 2, 2), "Lost"),
        ((3, 2, 3), "Needs Attention"),
        ((2, 2, 3), "Needs Attention"),
    ],
)
def test_first_matching_segment_wins(spark, scores, name):
    df = spark.createDataFrame([scores], "r int, f int, m int")
    assert df.select(rfm.segment_of(F.col("r"), F.col("f"), F.col("m"))).first()[0] == name


def test_missing_month_separates_lag_from_calendar_shift(spark):
    monthly = spark.createDataFrame([(date(2024, 1, 1), Decimal("10")), (date(2024, 3, 1), Decimal("15"))], "month date, revenue decimal(12,2)")
    by_lag = {r["month"]: r for r in rows(growth.growth_by_lag(monthly))}
    assert (by_lag["2024-03"]["prev_month_revenue"], by_lag["2024-03"]["mom_growth_pct"]) == (10.0, 50.0)
    by_calendar = {r["month"]: r for r in rows(growth.growth_by_calendar(monthly))}
    assert by_calendar["2024-03"]["revenue_prior_month"] is None
    assert set(by_calendar) == {"2024-01", "2024-03"}


def test_zero_base_gives_no_growth(spark):
    monthly = spark.createDataFrame([(date(2024, 1, 1), Decimal("0")), (date(2024, 2, 1), Decimal("100"))], "month date, revenue decimal(12,2)")
    assert [r["mom_growth_pct"] for r in rows(growth.growth_by_lag(monthly).orderBy("month"))] == [None, None]
    assert [r["mom_growth"] for r in rows(growth.growth_by_calendar(monthly))] == [None, None]


def test_cohort_counts_non_buyers_and_drops_negative_months(spark):
    star = make_star(
        spark,
        [(1, date(2024, 2, 10), "control"), (2, date(2024, 2, 20), "control")],
        [(1, 1, date(2024, 1, 5), DONE), (2, 1, date(2024, 3, 1), DONE), (3, 1, date(2024, 3, 9), DONE), (4, 1, date(2025, 3, 1), DONE)],
    )
    assert rows(cohort.cohort_retention(star)) == [
        {"cohort_month": "2024-02", "month_index": 1, "active_customers": 1, "cohort_customers": 2, "retention_pct": 50.0}
    ]
    (heat,) = rows(cohort.cohort_heatmap(star))
    assert heat["m1"] == 1 and heat["m0"] == 0 and heat["m12"] == 0
    assert rows(cohort.cohort_pct_of_total(star))[0]["pct_of_total"] == 1.0


def _experiment(spark, groups=("treatment", "control")):
    day = date(2024, 1, 2)
    customers = [(i, SIGNUP, groups[i % 2]) for i in range(8)]
    # The order carries the other group on purpose: tests use the customer's.
    orders = [(i, i, day, DONE, i < 6, groups[(i + 1) % 2]) for i in range(7)]
    return make_star(spark, customers, orders, [(i, 1, 1, 10, 10 + i * i) for i in range(5)])


def test_groups_are_picked_by_name_and_denominator_is_all_customers(spark):
    star = _experiment(spark)
    conversion = {r["ab_test_group"]: r for r in rows(abtest.ab_conversion(star))}
    assert {g: (r["converted"], r["customers"]) for g, r in conversion.items()} == {"control": (3, 4), "treatment": (3, 4)}
    (z,) = rows(abtest.ab_ztest(star))
    assert z["z_stat"] == 0.0
    (aov,) = rows(abtest.ab_aov(star))
    # treatment: customers 0, 2, 4 -> 10, 14, 26; control: 1, 3 -> 11, 19 (5 has an empty order)
    assert (aov["control_mean"], aov["treatment_mean"]) == (15.0, round(50 / 3, 4))
    readout = {r["ab_test_group"]: r["total_orders"] for r in rows(abtest.ab_readout(star))}
    assert readout == {"control": 3, "treatment": 2}


def test_welch_statistic_by_hand(spark):
    (t,) = rows(abtest.ab_aov(_experiment(spark)))
    tm, cm = 50 / 3, 15.0
    tv = sum((x - tm) ** 2 for x in (10, 14, 26)) / 2
    cv = sum((x - cm) ** 2 for x in (11, 19)) / 1
    a, b = tv / 3, cv / 2
    assert t["t_stat"] == pytest.approx((tm - cm) / (a + b) ** 0.5, abs=1e-6)
    assert t["degrees_of_freedom"] == pytest.approx((a + b) ** 2 / (a * a / 2 + b * b / 1), abs=1e-4)


def test_tagging_and_line_totals(spark):
    customers = [(1, SIGNUP, "treatment"), (2, SIGNUP, "control")]
    star = make_star(
        spark,
        customers,
        [(1, 1, date(2024, 1, 1), DONE), (2, 1, date(2024, 2, 1), DONE), (3, 2, date(2024, 1, 31), DONE)],
        [(1, 1, 3, 0, 0), (2, 1, 1, 0, 0), (3, 1, 1, 0, 0)],
        [(1, "a", 1, "0.50")],
    )
    tagged = tag_orders(star.orders, star.customers, date(2024, 1, 1), date(2024, 1, 31))
    got = {r["order_id"]: (r["in_ab_test"], float(r["discount_pct"])) for r in rows(tagged)}
    assert got == {1: (True, 0.15), 2: (False, 0.0), 3: (True, 0.0)}
    totals = {r["order_id"]: r["line_total"] for r in rows(line_totals(star.lines, tagged, star.products))}
    assert totals == {1: Decimal("1.28"), 2: Decimal("0.50"), 3: Decimal("0.50")}  # 1.275 goes to the even cent
    factor = spark.createDataFrame([(1, 2.0)], "customer_id bigint, factor double")
    doubled = {r["order_id"]: r["line_total"] for r in rows(line_totals(star.lines, tagged, star.products, factor))}
    assert doubled == {1: Decimal("2.55"), 2: Decimal("1.00"), 3: Decimal("0.50")}


def test_rounding_rules_differ(spark):
    df = spark.createDataFrame([(Decimal("0.125"), Decimal("2.5"))], "a decimal(5,3), b decimal(5,1)")
    got = df.select(F.round("a", 2), F.bround("a", 2), F.round("b", 0), F.bround("b", 0)).first()
    assert [float(x) for x in got] == [0.13, 0.12, 3.0, 2.0]


def test_quality_reports_count_duplicates_and_orphans(spark):
    star = make_star(
        spark,
        [(1, SIGNUP, "control")],
        [(1, 1, SIGNUP, DONE), (2, 9, SIGNUP, DONE), (3, 9, SIGNUP, DONE)],
        [(1, 1, 1, 1, 1), (1, 1, 1, 1, 1), (77, 5, 1, 1, 1)],
        [(1, "a", 1, 2)],
    )
    items = star.order_items.withColumn("order_item_id", F.when(F.col("order_id") == 1, 5).cast("bigint"))
    broken = star.with_tables(order_items=lambda: items)
    pk = {r["table_name"]: r for r in rows(quality.primary_key_report(broken))}
    assert (pk["fact_order_items"]["duplicate_rows"], pk["fact_order_items"]["null_keys"]) == (1, 1)
    assert pk["fact_orders"]["distinct_keys"] == 3 and pk["fact_orders"]["duplicate_rows"] == 0
    fk = {r["reference"]: (r["orphan_rows"], r["orphan_keys"]) for r in rows(quality.foreign_key_report(broken))}
    assert fk == {
        "fact_orders.customer_id": (2, 1),
        "fact_orders.order_date": (0, 0),
        "fact_order_items.order_id": (1, 1),
        "fact_order_items.product_id": (1, 1),
    }


def test_calendar_attributes(spark):
    bounds = spark.createDataFrame([(date(2024, 2, 28), date(2024, 3, 2))], "first_day date, last_day date")
    days = rows(calendar_of(bounds))
    assert [d["date"].isoformat() for d in days] == ["2024-02-28", "2024-02-29", "2024-03-01", "2024-03-02"]
    assert days[-1] == {
        "date": date(2024, 3, 2), "day": 2, "month": 3, "month_name": "Mar", "quarter": 1, "year": 2024,
        "day_of_week": "Saturday", "is_weekend": True,
    }


def test_promo_scenario_goldens(spark):
    inputs = spark.createDataFrame([(7580, 0.708, 1131.0, 0.004, 0.42)], "reached bigint, conversion double, order_value double, lift_per_point double, margin double")
    got = [tuple(r) for r in scenario.promo_scenario(inputs).orderBy("discount").collect()]
    assert got == [
        (0.00, 0.708, 5367, 1131.00, 6070077.00, 2549432.34),
        (0.05, 0.728, 5518, 1074.45, 5928815.10, 2193661.59),
        (0.10, 0.748, 5670, 1017.90, 5771493.00, 1846877.76),
        (0.15, 0.768, 5821, 961.35, 5596018.35, 1510924.95),
        (0.20, 0.788, 5973, 904.80, 5404370.40, 1188961.49),
        (0.25, 0.808, 6125, 848.25, 5195531.25, 883240.31),
        (0.30, 0.828, 6276, 791.70, 4968709.20, 596245.10),
    ]
    assert scenario.promo_best_discount(inputs).first()["discount"] == 0.0


def test_promo_margin_never_goes_below_zero(spark):
    inputs = spark.createDataFrame([(100, 0.5, 10.0, 0.05, 0.1)], "reached bigint, conversion double, order_value double, lift_per_point double, margin double")
    got = {r["discount"]: r for r in scenario.promo_scenario(inputs, [0.3]).collect()}
    assert got[0.3]["projected_margin"] == 0.0
    assert got[0.3]["projected_conversion"] == 2.0  # not capped


def test_slicers_restrict_customers_orders_and_items(spark):
    star = make_star(
        spark,
        [(1, SIGNUP, "control"), (2, SIGNUP, "control")],
        [(1, 1, date(2024, 1, 1), DONE), (2, 1, date(2024, 6, 1), DONE), (3, 2, date(2024, 1, 1), DONE)],
        [(n, 1, 1, 10, 10) for n in (1, 2, 3)],
    )
    customers = star.customers.withColumn("country", F.when(F.col("customer_id") == 1, "A").otherwise("B"))
    sliced = kpi.apply_slicers(star.with_tables(customers=lambda: customers), countries=["A"], last_day=date(2024, 2, 1))
    (cards,) = rows(kpi.kpi_cards(sliced))
    assert (cards["total_revenue"], cards["total_orders"], cards["total_customers"]) == (10.0, 1, 1)
    late = kpi.apply_slicers(star, signup_from=SIGNUP + timedelta(days=1))
    assert rows(kpi.kpi_cards(late))[0]["total_orders"] == 0
    untouched = rows(kpi.kpi_cards(kpi.apply_slicers(star)))
    assert untouched == rows(kpi.kpi_cards(star))


def test_labels_follow_monetary_rank_and_must_match_k(spark):
    clustered = spark.createDataFrame(
        [(i, i, 1, Decimal(100 * (i + 1)), i) for i in range(5)],
        "customer_id bigint, recency_days int, frequency bigint, monetary decimal(12,2), cluster int",
    )
    labels = {r["cluster"]: r["segment_label"] for r in segment.label_clusters(clustered, 5).collect()}
    assert labels == {4 - i: label for i, label in enumerate(segment.LABELS)}
    with pytest.raises(ValueError):
        segment.label_clusters(clustered, 4)


def test_cluster_profile_rounds_half_to_even(spark):
    clustered = spark.createDataFrame(
        [(1, 0, 1, Decimal("0.10"), 0), (2, 0, 1, Decimal("0.40"), 0), (3, 0, 1, Decimal("0.30"), 1), (4, 0, 1, Decimal("0.40"), 1)],
        "customer_id bigint, recency_days int, frequency bigint, monetary decimal(12,2), cluster int",
    )
    got = {r["cluster"]: r["monetary"] for r in segment.cluster_profile(clustered).collect()}
    assert got == {0: 0.2, 1: 0.4}  # 0.25 and 0.35


def test_constant_column_is_centred_only(spark):
    rfm_rows = spark.createDataFrame([(1, 5, 1, 10.0), (2, 5, 3, 20.0)], "customer_id bigint, recency_days int, frequency bigint, monetary double")
    scaled = segment.scale_rfm(rfm_rows).collect()
    assert [r["recency_scaled"] for r in scaled] == [0.0, 0.0]
    assert sorted(round(r["frequency_scaled"], 9) for r in scaled) == [-1.0, 1.0]  # population deviation


def test_category_totals_equal_the_card_with_unknown_members(spark):
    orders = [(1, 1, SIGNUP, DONE), (2, 99, SIGNUP, DONE)]
    items = [(1, 1, 2, 5, 10), (1, 77, 1, 3, 3), (2, 1, 1, 5, 5), (66, 1, 4, 5, 20)]
    star = make_star(spark, [(1, SIGNUP, "control")], orders, items, [(1, "Toys", 2, 5)])
    card = kpi.kpi_cards(star).first()["total_revenue"]
    categories = {r["category"]: r["gross_revenue"] for r in kpi.revenue_by_category(star).collect()}
    assert categories == {"Toys": 35.0, None: 3.0} and sum(categories.values()) == card
    channels = {r["channel"]: r["total_revenue"] for r in kpi.filtered_measure(star).collect()}
    assert channels == {"Web": 18.0, None: 20.0}
    net = {(r["country"], r["category"]): r["net_revenue"] for r in kpi.star_revenue(star).collect()}
    assert net == {("X", "Toys"): 10.0, ("X", None): 3.0, (None, "Toys"): 5.0}


def test_lines_of_other_orders_leave_before_the_sum(spark):
    """The plans of the experiment and of the features have the semi-join below the sum over lines."""
    from loomcart.catalog import queries

    for name in ("ab_readout", "clv_features"):
        plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        lines = plan.split("\n")
        at = next(i for i, text in enumerate(lines) if "lineitem" in text.lower() or "l_extendedprice" in text and "Relation" in text)
        above = [text for text in lines[:at]]
        semi = max(i for i, text in enumerate(above) if "LeftSemi" in text)
        sums = max(i for i, text in enumerate(above) if "Aggregate [" in text and "line_total" in text)
        assert sums < semi < at, name


def test_a_changed_file_changes_the_answer(spark, tmp_path):
    from loomcart.catalog import queries

    for name in ("orders", "customer", "lineitem", "nation", "part"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    report = queries()["web_share"]
    before = report(spark, str(tmp_path)).count()
    some = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where("o_custkey < 20")
    some.write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    after = report(spark, str(tmp_path)).count()
    assert 0 < after <= 20 < before


def test_star_revenue_holds_no_sum_per_order(spark):
    """Lines are summed per day, never into a group for each order, whose map would grow with a task's share of the orders."""
    from loomcart.catalog import queries

    plan = queries()["star_revenue"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    sums = [text for text in plan.split("\n") if "Aggregate [" in text and "line_total" in text]
    assert sums and not any("order_id" in text.split("Aggregate [")[1].split("]")[0] for text in sums)
