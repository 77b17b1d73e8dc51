"""Every report under its query name: callables (spark, folder of parquet tables) -> DataFrame."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.functions.scalar import as_money
from loomcart.operators import features, quality, rollup, tagging
from loomcart.operators.encode import fit_encoder
from loomcart.operators.order_values import completed, order_values
from loomcart.plans import abtest, churn, clv, cohort, exec_summary, explain, growth, kpi, rfm, scenario, segment, trees
from loomcart.session import materialise, scratch_path
from loomcart.sources import sinks
from loomcart.sources.checked import read_csv_checked
from loomcart.sources.schemas import SCHEMAS
from loomcart.sources.star import Star, drop_star, load_report, read_csv_table, register, store_star, stored_star
from loomcart.sources.tpch import TEST_END, TEST_START, read_star

Query = Callable[[SparkSession, str], DataFrame]

SIGNUP_SLICE = {"signup_from": datetime.date(1996, 1, 1), "signup_to": datetime.date(1998, 6, 30)}

SLICE = {
    "countries": ["NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_8", "NATION_13"],
    "channels": ["BUILDING", "MACHINERY"],
    "first_day": datetime.date(1996, 1, 1),
    "last_day": datetime.date(1999, 12, 31),
}

# Fitted models by the state of the files they were fitted on: reports share a fit as they would share a saved model, and
# a changed file means a new one. One fit of each kind is kept, and no query result.
_shared: dict[str, tuple[tuple, object]] = {}
#: The tables that the fits read.
FITTED_ON = ["customer", "nation", "orders", "lineitem"]


def _files(spark: SparkSession, folder: str, tables: list[str]) -> tuple:
    """Name, length and time of every file of some tables."""
    out = []
    for table in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{table}.parquet")
        found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
        while found.hasNext():
            file = found.next()
            out.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return tuple(sorted(out))


def _star(spark: SparkSession, folder: str) -> Star:
    return read_star(spark, folder)


def _fitted(name: str, train: Callable[[Star], object], spark: SparkSession, folder: str):
    state = (spark.sparkContext.applicationId, folder, _files(spark, folder, FITTED_ON))
    if name not in _shared or _shared[name][0] != state:
        _shared[name] = (state, train(_star(spark, folder)))
    return _shared[name][1]


def _on_star(report: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: report(_star(spark, folder))


def _on_segments(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(rfm.rfm_segments(_star(spark, folder)))


def _on_fit(name: str, train: Callable[[Star], object], report: Callable[[object], DataFrame]) -> Query:
    return lambda spark, folder: report(_fitted(name, train, spark, folder))


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as CSV with a header and read back with their types."""
    path = scratch_path(spark, "orders-csv")
    orders = _star(spark, folder).orders
    sinks.write_csv(orders.select(SCHEMAS["fact_orders"].names), path)
    return (
        read_csv_table(spark, path, "fact_orders")
        .groupBy("order_status", "channel", "in_ab_test")
        .agg(
            F.count("order_id").alias("orders"),
            F.min("order_date").alias("first_day"),
            F.max("order_date").alias("last_day"),
            as_money(F.sum("discount_pct")).alias("discounts"),
            F.sum("customer_id").alias("customer_id_sum"),
        )
    )


#: Orders that are spoilt before a checked load, by remainder of the order id: the column and what stands there instead.
SPOILT = {101: ("order_date", "not a date"), 103: ("channel", "Web,and more"), 107: ("order_id", None), 109: ("discount_pct", "0.12345")}


def csv_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as CSV with some rows spoilt: rows by reason of rejection, and those loaded with the sum of their customers."""
    path = scratch_path(spark, "orders-spoilt")
    texts = _star(spark, folder).orders.select(*[F.col(c).cast("string").alias(c) for c in SCHEMAS["fact_orders"].names])
    order = F.col("order_id").cast("long")
    for divisor, (column, value) in SPOILT.items():
        texts = texts.withColumn(f"_{divisor}", order % divisor == 0)
    for divisor, (column, value) in SPOILT.items():
        texts = texts.withColumn(column, F.when(F.col(f"_{divisor}"), F.lit(value)).otherwise(F.col(column)))
    texts.select(SCHEMAS["fact_orders"].names).write.option("header", True).option("quote", "").csv(path)
    load = read_csv_checked(spark, path, "fact_orders")
    loaded = load.good.agg(F.count(F.lit(1)).alias("rows"), F.sum("customer_id").alias("customer_id_sum"))
    return load.by_reason().withColumn("customer_id_sum", F.lit(None).cast("long")).unionByName(
        loaded.select(F.lit("loaded").alias("reason"), "rows", "customer_id_sum")
    )


def stored_order_values(spark: SparkSession, folder: str) -> DataFrame:
    """Order values on stored, bucketed tables."""
    store_star(_star(spark, folder), scratch_path(spark, "stored"), prefix="stored_")
    return kpi.completed_values(stored_star(spark, "stored_"))


def rollup_growth(spark: SparkSession, folder: str) -> DataFrame:
    """Growth on a roll-up that was loaded in three batches, one of them twice."""
    path = scratch_path(spark, "rollup")
    star = _star(spark, folder)
    values = order_values(completed(star.orders), star.lines).select("order_id", "order_date", "order_value")
    for part, version in ((0, 1), (1, 2), (1, 2), (2, 3)):
        rollup.load_batch(values.where(F.col("order_id") % 3 == part), path, version)
    return growth.growth_by_lag(rollup.monthly_totals(spark, path)).orderBy("month")


#: A known model of three trees over ``KNOWN_FEATURES``: tree, node, feature, threshold, categories, left, right, value.
KNOWN_FEATURES = ["age", "orders_0_180", "spend_0_180", "avg_order_value", "channel_web_share"]
KNOWN_TREES = [
    (0, 0, 1, 2.5, None, 1, 2, None, 64.0, 0.25),
    (0, 1, 4, 0.5, None, 3, 4, None, 40.0, 0.125),
    (0, 2, -1, None, None, None, None, -0.5, 24.0, None),
    (0, 3, -1, None, None, None, None, 0.75, 16.0, None),
    (0, 4, -1, None, None, None, None, 0.25, 24.0, None),
    (1, 0, 2, 250000.0, None, 1, 2, None, 64.0, 0.0625),
    (1, 1, -1, None, None, None, None, 0.125, 32.0, None),
    (1, 2, 0, 40.0, None, 3, 4, None, 32.0, 0.5),
    (1, 3, -1, None, None, None, None, -0.25, 20.0, None),
    (1, 4, -1, None, None, None, None, -0.375, 12.0, None),
    (2, 0, 0, None, [19.0, 25.0, 33.0, 60.0], 1, 2, None, 64.0, 0.03125),
    (2, 1, -1, None, None, None, None, 0.0625, 10.0, None),
    (2, 2, -1, None, None, None, None, -0.0625, 54.0, None),
]


def known_tree_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Importances of the known model, next to each feature's mean over the active customers."""
    shares = trees.importance(trees.tree_rows(spark, KNOWN_TREES), KNOWN_FEATURES).select("feature", F.round("importance", 9).alias("importance"))
    rows = features.churn_features(_star(spark, folder)).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in KNOWN_FEATURES])
    means = rows.select(F.explode(F.create_map(*[x for c in KNOWN_FEATURES for x in (F.lit(c), F.round(c, 6))])).alias("feature", "mean"))
    return shares.join(means, "feature").orderBy(F.desc("importance"), "feature")


def known_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Margins and probabilities of the known model for every active customer."""
    rows = churn.churn_split(_star(spark, folder))
    x = F.array(*[F.col(c).cast("double") for c in KNOWN_FEATURES])
    scored = trees.with_margin(rows, trees.tree_rows(spark, KNOWN_TREES), x)
    return scored.select("customer_id", "margin", F.round(trees.probability(F.col("margin")), 9).alias("probability"))


def ab_tagging(star: Star) -> DataFrame:
    first, last = (datetime.date.fromisoformat(d) for d in (TEST_START, TEST_END))
    return tagging.tag_orders(star.orders, star.customers, first, last).select(
        "order_id",
        "ab_test_group",
        "in_ab_test",
        F.col("discount_pct").cast("double").alias("discount_pct"),
    )


def line_totals(star: Star) -> DataFrame:
    lines = tagging.line_totals(star.lines, star.orders, star.products)
    return lines.select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        *[F.col(c).cast("double").alias(c) for c in ("unit_price", "discount_pct", "line_total")],
    )


def _money_out(df: DataFrame) -> DataFrame:
    return df.withColumn("monetary", F.col("monetary").cast("double"))


def rfm_features_scaled(star: Star) -> DataFrame:
    scaled = segment.scale_rfm(materialise(rfm.rfm_raw(star), "rfm"))
    return scaled.select("customer_id", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in segment.SCALED])


def kmeans_assign(star: Star) -> DataFrame:
    """Customers by nearest segment centroid, next to their rule-based segment."""
    scaled = segment.scale_rfm(materialise(rfm.rfm_segments(star), "rfm"))
    nearest = segment.nearest_centroid(scaled, segment.segment_centroids(scaled), "rfm_segment")
    return nearest.select("customer_id", "rfm_segment", F.col("nearest").alias("nearest_segment"))


def _labelled(star: Star) -> DataFrame:
    """Customers in five clusters known beforehand, their recency scores, labelled as fitted clusters are."""
    clustered = materialise(rfm.rfm_segments(star), "clusters").withColumn("cluster", F.col("r_score") - 1)
    return segment.label_clusters(clustered, len(segment.LABELS))


def _on_labels(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(_labelled(_star(spark, folder)))


def _known_clv(star: Star) -> clv.ClvRun:
    """Early spend as the prediction of later spend, for the reports around a fit."""
    return clv.ClvRun(clv.clv_split(star).withColumn("prediction", F.col("spend_first90")), [], None)


def _known_churn(star: Star) -> churn.ChurnRun:
    """A risk that falls with the number of orders, for the reports around a fit."""
    scored = churn.churn_split(star).withColumn("p", 1 / (1 + F.col("orders_0_180") / 2))
    vector = F.array(1 - F.col("p"), F.col("p"))
    return churn.ChurnRun(scored.withColumn("rawPrediction", array_to_vector(vector)), [], None)


def _rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("value", F.round("value", 9))


def churn_one_hot(star: Star) -> DataFrame:
    """The encoded features of every active customer."""
    table = materialise(churn.churn_split(star), "one-hot")
    encoder = fit_encoder(table.where(~F.col("is_test")), churn.NUMBERS, churn.CATEGORIES)
    return encoder.one_hot(table).select("customer_id", F.array(*[F.col(f"_x{i}") for i in range(len(encoder.names()))]).alias("x")).select(
        "customer_id", F.posexplode("x").alias("column", "value")
    )


def sql_views(spark: SparkSession, folder: str) -> DataFrame:
    """A report in SQL over the registered tables."""
    register(_star(spark, folder))
    return spark.sql(
        """SELECT c.country, o.channel, count(*) AS orders, count(DISTINCT o.customer_id) AS customers
        FROM fact_orders o JOIN dim_customers c ON c.customer_id = o.customer_id
        WHERE o.order_status = 'Completed' GROUP BY c.country, o.channel"""
    )


def _signed_up(report: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: report(kpi.apply_slicers(_star(spark, folder), **SIGNUP_SLICE))


def _split_out(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("customer_id", *columns, "is_test")


TRAINERS = {"kmeans": segment.segment_customers_by_kmeans, "clv": clv.train_clv, "churn": churn.train_churn}


def fit_models() -> dict[str, Callable[[SparkSession, str], object]]:
    """Fits that several queries share, by name; calling one keeps it for them."""
    return {name: lambda spark, folder, n=name, t=train: _fitted(n, t, spark, folder) for name, train in TRAINERS.items()}


def queries() -> dict[str, Query]:
    kmeans, clv_fit, churn_fit = ((name, TRAINERS[name]) for name in ("kmeans", "clv", "churn"))
    return {
        # sources, schema, data quality
        "load_report": _on_star(load_report),
        "csv_roundtrip": csv_roundtrip,
        "csv_checked": csv_checked,
        "dq_primary_key": _on_star(quality.primary_key_report),
        "dq_foreign_key": _on_star(quality.foreign_key_report),
        "orders_without_items": _on_star(kpi.orders_without_items),
        # calendar and derived facts
        "calendar_dim": _on_star(lambda s: s.dates),
        "ab_tagging": _on_star(ab_tagging),
        "line_totals": _on_star(line_totals),
        "order_values": _on_star(kpi.completed_values),
        "stored_order_values": stored_order_values,
        # RFM
        "rfm_raw": _on_star(lambda s: _money_out(rfm.rfm_raw(s))),
        "rfm_scores": _on_star(lambda s: _money_out(rfm.rfm_scores(s))),
        "rfm_segments": _on_star(lambda s: _money_out(rfm.rfm_segments(s)).orderBy(F.desc("rfm_total"), "customer_id")),
        "scalar_subquery_recency": _on_star(lambda s: rfm.rfm_raw(s).select("customer_id", "recency_days")),
        "top_customers": _on_star(lambda s: _money_out(rfm.top_customers(s)).drop("last_order_date")),
        # cohorts
        "cohort_retention": _on_star(cohort.cohort_retention),
        "cohort_heatmap": _on_star(cohort.cohort_heatmap),
        "active_customers": _on_star(cohort.active_customers),
        "cohort_pct_of_total": _on_star(cohort.cohort_pct_of_total),
        # growth
        "revenue_growth": _on_star(growth.revenue_growth),
        "rollup_growth": rollup_growth,
        "latest_month": _on_star(growth.latest_month),
        "calendar_growth": _on_star(growth.calendar_growth),
        "revenue_mtd": _on_star(growth.revenue_mtd),
        # measures and dashboard datasets
        "kpi_cards": _on_star(kpi.kpi_cards),
        "sliced_kpis": _on_star(lambda s: kpi.kpi_cards(kpi.apply_slicers(s, **SLICE))),
        "repeat_purchase_rate": _on_star(kpi.repeat_purchase_rate),
        "filtered_measure": _on_star(kpi.filtered_measure),
        "revenue_by_category": _on_star(kpi.revenue_by_category),
        "star_revenue": _on_star(kpi.star_revenue),
        "web_share": _on_star(kpi.web_share),
        "segment_customers": _on_segments(kpi.segment_customers),
        "segment_revenue": _on_segments(kpi.segment_revenue),
        "segment_share": _on_segments(kpi.segment_share),
        "segment_breakdown": _on_segments(kpi.segment_breakdown),
        "segment_drill": _on_segments(lambda d: kpi.segment_drill(d, rfm.AT_RISK)),
        "labelled_customers": _on_labels(lambda d: d.select("customer_id", "cluster", "segment_label")),
        "label_profile": _on_labels(
            lambda d: segment.cluster_profile(d).join(d.select("cluster", "segment_label").distinct(), "cluster").orderBy(F.desc("monetary"))
        ),
        "label_customers": _on_labels(lambda d: kpi.segment_customers(d, "segment_label")),
        "label_revenue": _on_labels(lambda d: kpi.segment_revenue(d, "segment_label")),
        "label_share": _on_labels(lambda d: kpi.segment_share(d, "segment_label")),
        "label_breakdown": _on_labels(lambda d: kpi.segment_breakdown(d, "segment_label")),
        "signup_cohorts": _signed_up(cohort.cohort_retention),
        "signup_segments": _signed_up(lambda s: kpi.segment_customers(rfm.rfm_segments(s))),
        "sql_views": sql_views,
        "exec_kpis": _on_star(exec_summary.exec_kpis),
        # experiment
        "ab_readout": _on_star(abtest.ab_readout),
        "ab_conversion": _on_star(abtest.ab_conversion),
        "ab_ztest": _on_star(abtest.ab_ztest),
        "ab_revenue_per_customer": _on_star(abtest.ab_revenue_per_customer),
        "ab_aov": _on_star(abtest.ab_aov),
        "ab_mde": _on_star(abtest.ab_mde),
        "ab_summary": _on_star(abtest.ab_summary),
        # what-if
        "promo_scenario": _on_star(lambda s: scenario.promo_scenario(scenario.promo_assumptions(s))),
        "promo_grid": _on_star(lambda s: scenario.promo_scenario(scenario.promo_assumptions(s), scenario.FINE_DISCOUNTS)),
        "promo_best_discount": _on_star(lambda s: scenario.promo_best_discount(scenario.promo_assumptions(s))),
        # features and splits
        "eligible_customers": _on_star(features.eligible_buyers),
        "clv_features": _on_star(features.clv_features),
        "churn_features": _on_star(features.churn_features),
        "churn_base_rate": _on_star(lambda s: features.churn_base_rate(features.churn_features(s))),
        "clv_split": _on_star(lambda s: _split_out(clv.clv_split(s))),
        "churn_split": _on_star(lambda s: _split_out(churn.churn_split(s), "churned")),
        "churn_class_weight": _on_star(lambda s: churn.churn_class_weight(churn.churn_split(s))),
        # segmentation
        "rfm_features_scaled": _on_star(rfm_features_scaled),
        "kmeans_assign": _on_star(kmeans_assign),
        "kmeans_step": _on_star(segment.segment_step),
        "kmeans_elbow": _on_star(segment.kmeans_elbow),
        "kmeans_segments": _on_fit(*kmeans, lambda run: _money_out(segment.kmeans_segments(run))),
        "segment_profile": _on_fit(*kmeans, segment.segment_profile),
        # the reports around a fit, on predictions that SQL can repeat
        "churn_one_hot": _on_star(churn_one_hot),
        "known_clv_metrics": _on_star(lambda s: _rounded(clv.clv_metrics(_known_clv(s)))),
        "known_churn_metrics": _on_star(lambda s: _rounded(churn.churn_metrics(_known_churn(s)))),
        "known_churn_report": _on_star(lambda s: churn.churn_class_report(_known_churn(s))),
        "known_churn_averages": _on_star(lambda s: churn.churn_report_averages(_known_churn(s))),
        "known_churn_top100": _on_star(lambda s: churn.churn_risk_top(_known_churn(s))),
        "known_tree_scores": known_tree_scores,
        "known_tree_importance": known_tree_importance,
        # models
        "clv_predictions": _on_fit(*clv_fit, clv.clv_predictions),
        "clv_metrics": _on_fit(*clv_fit, clv.clv_metrics),
        "clv_importance": _on_fit(*clv_fit, clv.clv_importance),
        "churn_predictions": _on_fit(*churn_fit, churn.churn_predictions),
        "churn_metrics": _on_fit(*churn_fit, churn.churn_metrics),
        "churn_class_report": _on_fit(*churn_fit, churn.churn_class_report),
        "churn_report_averages": _on_fit(*churn_fit, churn.churn_report_averages),
        "churn_risk_top100": _on_fit(*churn_fit, churn.churn_risk_top),
        "churn_explain": _on_fit(*churn_fit, explain.churn_explain),
    }
