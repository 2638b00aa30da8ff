"""The queries, one per operator; each takes a session and the folder of the tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.catalog import sales as s
from holdfast.functions import predicates as pred
from holdfast.functions import values as val
from holdfast.operators import activity as act
from holdfast.operators import commit, increments, sketches
from holdfast.operators import assign, categories, features, joins, margins, metrics, model, prepare
from holdfast.operators import publish, quantiles, ranking, risk, roc, rollup, sampling, targeting
from holdfast.session import scratch_path, store
from holdfast.sources.contacts import distinct_contacts
from holdfast.sources.feedback import NOTE_COLUMNS, read_feedback
from holdfast.sources.tables import TableRef, one_month, period_slice, read_table, trailing_months
from holdfast.spec import KEYS, CodeOverride, Lookup, Remap

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINE = ("order_no", "line_no")
SALES_COLUMNS = (*LINE, "client_id", "product", "branch", "sale_date", "amount", "volume")


# Totals and what is made of them, compared to 4 decimals: engines add in different orders.
TOTALS: dict[str, tuple[str, ...]] = {
    "src_period_slice": ("monetary_value",),
    "sink_roundtrip": ("monetary_value",),
    "activity": ("monetary_value", "volume"),
    "activity_multi_measure": ("monetary_value_usd", "monetary_value", "volume"),
    "activity_small_addends": ("monetary_value", "volume"),
    "features": ("monetary_value", "volume"),
    "features_training": ("monetary_value", "volume"),
    "union_tagged": ("monetary_value",),
    "label_window": ("future_spend_total", "future_spend_avg"),
    "agg_sales_12m": ("sales_12m",),
    "agg_sales_12m_filtered": ("sales_12m",),
    "share_of_client": ("total_value", "client_value"),
    "join_margin": ("monetary_value",),
    "risk_view": ("sales_12m",),
    "client_opportunity": ("potential_win",),
    "client_list": ("potential_win",),
    "client_targets": ("potential_win",),
    "topk_opportunities": ("total_value",),
    "target_detail": ("total_value",),
    "activity_increments": ("monetary_value", "volume"),
    "sales_12m_increments": ("sales_12m",),
    "sink_commit": ("monetary_value",),
}


def query(step: Callable[[s.Tables], DataFrame], name: str | None = None):
    name = name or step.__name__

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(step(s.Tables(spark, folder)), 4, *TOTALS.get(name, ()))

    QUERIES[name] = run
    return step


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Rounded to 8 decimals and then to ``digits``, so that the noise of an addition order
    does not decide about a value half way between two."""

    def twice(c: str):
        return val.round_half_even(val.round_half_even(F.col(c), 8), digits)

    return df.withColumns({c: twice(c) for c in columns}) if columns else df


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


# Sources


@query
def src_sales(m):
    return m.lines.select(*SALES_COLUMNS)


@query
def src_window_27m(m):
    return m.raw.select(*SALES_COLUMNS)


@query
def src_contacts_distinct(m):
    orders, customer = m.table("orders"), m.table("customer")
    raw = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").cast("string").alias("client_id"),
        F.col("c_name").alias("Compa__a"),
        F.col("c_nationkey").cast("string").alias("Codigo_Sucursal"),
    )
    renames = {"Compa__a": "company", "Codigo_Sucursal": "branch_code"}
    return distinct_contacts(raw, renames, "client_id")


def _monthly_results(m) -> DataFrame:
    rows = m.activity_plan
    return rows.select(
        "client_id",
        "product",
        "monetary_value",
        F.col("branch").alias("country"),
        val.period_text(F.col("period")).alias("period"),
    )


@query
def src_period_slice(m):
    path = scratch_path(m.spark, "results")
    publish.write_result(_monthly_results(m), path)
    # Partition values are text, not numbers.
    stored = read_table(
        m.spark, TableRef(path, schema=_monthly_results(m).schema)
    )
    return period_slice(stored, "200107")


def _text_orders(m) -> DataFrame:
    """Orders whose date is text, day first, as one market has it; some with spaces."""
    date = F.date_format("o_orderdate", "dd/MM/yyyy")
    spaced = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" "), date, F.lit(" ")))
    rows = m.table("orders").select(
        "o_orderkey",
        F.coalesce(spaced, date).alias("day_text"),
        F.date_format("o_orderdate", "MM/yyyy").alias("month_text"),
    )
    return store(rows, "text-orders")


@query
def src_window_text(m):
    """The window on both kinds of text dates; the source filters either."""
    orders = _text_orders(m)
    by_day = trailing_months(orders, "day_text", s.AS_OF, 27, "dd/MM/yyyy", after=True)
    by_month = trailing_months(orders, "month_text", s.AS_OF, 27, "MM/yyyy")
    kinds = {"day": by_day, "month": by_month}
    first, second = (df.withColumn("kind", F.lit(kind)) for kind, df in kinds.items())
    return first.unionByName(second)


# Projections


@query
def proj_period(m):
    rows = m.lines
    period = val.period_from(F.col("sale_date"))
    return rows.select(
        *LINE, period.alias("period"), val.period_text(period).alias("period_text")
    )


@query
def proj_period_formats(m):
    date = F.col("o_orderdate")
    raw = m.table("orders").select(
        "o_orderkey",
        F.concat(F.lit("  "), F.date_format(date, "dd/MM/yyyy"), F.lit(" ")).alias("as_text"),
        F.date_format(date, "yyyyMMdd").cast("int").alias("as_key"),
        F.date_format(date, "MM/yyyy").alias("as_month"),
    )
    return raw.select(
        "o_orderkey",
        val.parse_date(F.col("as_text"), "dd/MM/yyyy").alias("day_of_text"),
        val.parse_date(F.col("as_key"), "yyyyMMdd").alias("day_of_key"),
        val.period_from(F.col("as_text"), "dd/MM/yyyy").alias("period_of_text"),
        val.period_from(F.col("as_key"), "yyyyMMdd").alias("period_of_key"),
        val.period_from(F.col("as_month"), "MM/yyyy").alias("period_of_month"),
    )


@query
def proj_code_override(m):
    rules = (
        CodeOverride("product", "size_code", (1, 2, 3), "CLASS A"),
        CodeOverride("product", "size_code", (10,), "CLASS B"),
        CodeOverride("product", "size_code", (3, 20), "CLASS C"),
        CodeOverride("segment", "size_code", (10, 20), "PACKAGED"),
    )
    rows = prepare.apply_overrides(m.lines, rules)
    return rows.select(*LINE, "product", "segment")


@query
def proj_trim_key(m):
    rows = m.lines.withColumn(
        "branch", F.concat(F.lit("  "), F.col("branch"), F.lit(" "))
    )
    region = m.table("region")
    return (
        rows.withColumn("branch", F.trim("branch"))
        .join(region, F.col("branch") == F.col("r_name"))
        .select(*LINE, "branch", F.col("r_regionkey").cast("long").alias("region_key"))
    )


REPAIRS = {
    "ECONOMY": "Economico",
    "LARGE": "Grande",
    "MEDIUM": "Mediano",
    "SMALL": "Chico",
    "NONE SUCH": "Nada",
}


@query
def proj_label_repair(m):
    product = val.repair_text(F.col("product"), REPAIRS).alias("product")
    return m.lines.select(*LINE, product)


@query
def proj_map_override(m):
    remap = Remap("remap", ("product_code", "code"), "product", "product_new")
    new_names = (
        m.table("part")
        .where(F.col("p_size") > 25)
        .select(
            F.col("p_partkey").alias("code"),
            F.concat(F.lit("NEW "), "p_type").alias("product_new"),
        )
    )
    rows = prepare.remap_values(m.lines, new_names, remap)
    return rows.select(*LINE, "product_code", "product")


@query
def proj_prefix_class(m):
    prefix = F.when(F.col("c_nationkey") < 10, "DNI").otherwise("20")
    document = F.concat(prefix, F.col("c_custkey").cast("string"))
    rows = m.table("customer").select("c_custkey", document.alias("document"))
    kind = val.class_from_prefix(F.col("document"), "DNI", "DNI", "RUC")
    return rows.withColumn("document_kind", kind)


@query
def proj_flag(m):
    rows = prepare.set_flags(m.lines, ("flag_a", "flag_b"))
    return longs(rows.select(*LINE, "flag_a", "flag_b"), "flag_a", "flag_b")


@query
def proj_fill(m):
    rows = m.table("lineitem").select(
        F.col("l_orderkey").alias("order_no"),
        F.col("l_linenumber").cast("long").alias("line_no"),
        F.nullif(F.col("l_discount"), F.lit(0.05)).alias("discount"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("kind"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("status"),
    )
    return prepare.fill_numeric(rows, {"discount": 0.0, "kind": s.LABELS.no_seller})


@query
def proj_round_even(m):
    half, price = F.col("l_quantity") / 2, F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return m.table("lineitem").select(
        F.col("l_orderkey").alias("order_no"),
        F.col("l_linenumber").cast("long").alias("line_no"),
        val.to_whole(half).alias("half_quantity"),
        val.round_half_even(price, 2).alias("price"),
    )


@query
def buy_probability(m):
    rows = risk.buy_probability(m.risk_plan)
    return rows.select(*KEYS, "risk_level", "churn_probability", "buy_probability")


# Filters


@query
def filter_not_in_keep_null(m):
    keep = pred.not_in_keep_null(F.col("product"), ["SMALL", "LARGE"])
    other = pred.differs_keep_null(F.nullif(F.col("segment"), F.lit("BUILDING")), "MACHINERY")
    return m.lines.where(keep & other).select(*LINE, "product", "segment")


@query
def filter_in_or_null(m):
    keep = pred.in_list_or_null(F.col("product"), ["SMALL", "LARGE"])
    return m.lines.where(keep).select(*LINE, "product")


@query
def filter_period_windows(m):
    end, period = m.training_end, F.col("period")
    marks = {
        "in_older": pred.in_closed_window(period, F.add_months(end, -12), 12),
        "in_recent": pred.in_closed_window(period, end, 11),
        "in_features": pred.in_half_open_window(period, end, 12),
    }
    rows = m.activity.select(
        *KEYS, "period", *[m.cast("long").alias(n) for n, m in marks.items()]
    )
    return rows.where(F.col("in_older") + F.col("in_recent") + F.col("in_features") > 0)


@query
def history_view(m):
    return publish.history_view(m.lines, "2001-08-15").select(*SALES_COLUMNS)


@query
def distinct_rows(m):
    return m.lines.select(*KEYS, "segment").distinct()


# Joins


def _managers(m) -> DataFrame:
    region = m.table("region").where(F.col("r_name") != "ASIA")
    manager = F.concat(F.lit("M"), F.col("r_regionkey").cast("string"))
    return region.select(F.col("r_name").alias("zone"), manager.alias("manager"))


BY_ZONE = Lookup("managers", (("branch", "zone"),), {"manager": "manager"})


@query
def join_left_dim(m):
    rows = joins.lookup(m.lines, _managers(m), BY_ZONE)
    return rows.select(*LINE, "branch", "manager")


@query
def join_multi_dim(m):
    units = (
        m.table("customer")
        .join(m.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(m.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "c_mktsegment")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    two_keys = Lookup("units", (("branch", "r_name"), ("segment", "c_mktsegment")), {"unit": "n"})
    by_code = Lookup("parts", (("product_code", "p_partkey"),), {"brand": "p_brand"})
    replaced = Lookup("managers", (("branch", "zone"),), {"seller": "manager"})
    rows = joins.lookup(m.lines, _managers(m), replaced)
    rows = joins.lookup(rows, units, two_keys)
    rows = joins.lookup(rows, m.table("part"), by_code)
    return rows.select(*LINE, "seller", "unit", "brand")


@query
def join_cast_keys(m):
    names = m.table("supplier").select(
        F.concat(F.lit(" "), F.col("s_suppkey").cast("string")).alias("client_id"),
        F.col("s_name").alias("name"),
    )
    rows = m.lines.select(*LINE, "client_id")
    return joins.join_same_type(rows, names, ["client_id"], "left", "long")


@query
def join_inner_attrs(m):
    m.share_raw()
    attributes = joins.latest_values(
        m.raw, ["client_id", "product"], s.MARKET.attributes, "sale_date"
    )
    attributes = prepare.set_flags(attributes, s.MARKET.flags)
    rows = joins.join_back(m.features, attributes, ["client_id", "product"], "inner")
    return longs(rows.select(*KEYS, "frequency", *s.MARKET.attributes), *s.MARKET.flags)


@query
def label_training(m):
    return longs(m.training.select(*KEYS, "frequency", "target"), "target")


@query
def join_semi(m):
    ids = m.risk_plan.where(risk.at_risk())
    return joins.keep_members(m.lines, ids, "client_id").select(
        *LINE, "client_id"
    )


@query
def join_anti(m):
    ids = m.risk_plan.where(risk.at_risk())
    return joins.drop_members(m.lines, ids, "client_id").select(
        *LINE, "client_id"
    )


@query
def share_of_client(m):
    rows = rollup.share_of_client(m.risk)
    return rounded(rows.select(*KEYS, "total_value", "client_value", "share"), 6, "share")


@query
def join_margin(m):
    m.share_raw()
    rows = margins.join_margin(m.features, m.margins)
    return rounded(rows.select(*KEYS, "monetary_value", "margin"), 6, "margin")


@query
def risk_view(m):
    m.share_raw()
    raw, scoped = m.raw, m.scoped
    attributes = joins.latest_values(scoped, *s.MARKET.views[0], "sale_date")
    totals = act.sales_total(raw)
    flags = joins.latest_values(raw, ["client_id", "product"], s.MARKET.flags, "sale_date")
    view = publish.risk_view(
        m.risk_plan, attributes, totals, prepare.set_flags(flags, s.MARKET.flags)
    )
    return longs(
        view.select(
            *KEYS, "client_name", "risk_level", "churn_probability", "analysis_period",
            "last_purchase", "monetary_value", "frequency", *s.MARKET.views[0][1],
            "sales_12m", *s.MARKET.flags,
        ),
        *s.MARKET.flags,
    )


# Aggregates


def _feature_columns(df: DataFrame) -> DataFrame:
    return rounded(
        df.select(
            *KEYS, "monetary_value", "frequency", "volume", "last_purchase", "max_gap",
            "recency", "ref_period", "ref_kind", "mean_gap", "analysis_period",
        ),
        6,
        "mean_gap",
    )


@query
def activity(m):
    return longs(m.activity_plan, "frequency")


@query
def activity_multi_measure(m):
    measures = {"monetary_value_usd": "amount_usd", "monetary_value": "amount"}
    rows = act.monthly_activity(m.scoped, measures)
    return longs(rows, "frequency")


@query
def activity_small_addends(m):
    """Volumes of a millionth: what rounding each of them would lose."""
    small = F.col("volume") / F.lit(1e6)
    lines = m.scoped.withColumns({"volume": small, "amount": small * F.lit(-3.0)})
    keys = ["client_id", "branch"]
    rows = act.monthly_activity(lines, {"monetary_value": "amount"})
    rows = rows.groupBy(*keys).agg(
        (val.exact_sum(F.col("monetary_value")) * 1e6).alias("monetary_value"),
        (val.exact_sum(F.col("volume")) * 1e6).alias("volume"),
    )
    return rows


@query
def win_gap_months(m):
    return longs(m.gaps.select(*KEYS, "period", "max_gap"), "max_gap")


@query
def past_reference(m):
    return act.past_reference(m.activity, m.end)


@query
def agg_last_transaction(m):
    end = m.end
    return act.reference_period(m.activity, end, 12, 12, "max")


MONTHS = ("2001-07-01", "2001-08-01", "2001-09-01")


def _by_increments(m, step) -> DataFrame:
    """``step`` for three successive months: the first after a load of the whole history, each
    later one after a load of one month's lines and the drop of the oldest month."""
    parts = increments.MonthlyParts(m.spark, scratch_path(m.spark, "parts"), s.MARKET.measures)
    orders, rows = m.table("orders"), []
    for i, as_of in enumerate(MONTHS):
        if i:
            new = one_month(orders, "o_orderdate", MONTHS[i - 1])
        else:
            window = trailing_months(orders, "o_orderdate", as_of, s.MARKET.windows.history)
            new = window.where(F.col("o_orderdate") < F.lit(as_of).cast("date"))
        lines = store(s.lines_of(m.spark, m.folder, new).drop(*s.LINE_ONLY), "lines")
        parts.load(pred.apply_rules(lines, s.MARKET.scope_rules), lines)
        parts.drop_before(dt.date.fromisoformat(as_of), s.MARKET.windows.history)
        found = step(parts, as_of).withColumn("as_of", F.lit(as_of))
        rows.append(store(found, "increment"))
    return reduce(DataFrame.unionByName, rows)


@query
def activity_increments(m):
    return _by_increments(m, lambda parts, as_of: parts.activity(as_of))


@query
def sales_12m_increments(m):
    return _by_increments(m, lambda parts, as_of: parts.sales_total(as_of))


@query
def last_transaction_increments(m):
    def last(parts, as_of):
        activity = parts.activity(as_of)
        return act.reference_period(activity, act.newest_period(activity), 0, 12, "max")

    return _by_increments(m, last)


def production_features(m):
    return _feature_columns(m.features)


query(production_features, "features")  # the name itself is the module here


@query
def features_training(m):
    return _feature_columns(m.training_features)


@query
def label_window(m):
    return longs(m.labels, "target")


@query
def agg_sales_12m(m):
    m.share_raw()
    return act.sales_total(m.raw)


@query
def agg_sales_12m_filtered(m):
    rules = (
        pred.Rule("data_kind", "not_in", ("O",)),
        pred.Rule("doc_type", "not_in", ("R", "A")),
    )
    columns = ["client_id", "branch", "period", "sale_date", "amount", "data_kind", "doc_type"]
    return act.sales_total(store(m.raw.select(*columns), "lines"), rules=rules)


@query
def distinct_pairs(m):
    return joins.distinct_pairs(m.lines, "product", "segment", "branch")


@query
def agg_client_name(m):
    return rollup.client_names(m.lines)


@query
def client_churn(m):
    rows = rollup.client_churn(m.risk_plan)
    return rounded(rows, 6, "client_churn_probability", "client_margin_est")


@query
def client_opportunity(m):
    return rollup.client_opportunity(m.risk_plan)


@query
def agg_risk_counts(m):
    return rollup.risk_counts(m.clients)


@query
def agg_seller_load(m):
    return assign.seller_load(m.clients)


@query
def band_client(m):
    graded = m.risk
    rows = rollup.band_clients(m.clients, graded, ["client_id"])
    return rows.select("client_id", "branch", "band")


@query
def band_client_branch(m):
    keys = ["client_id", "branch"]
    text = {c: F.col(c).cast("string") for c in keys}
    graded = m.risk
    rows = rollup.band_clients(m.clients.withColumns(text), graded.withColumns(text), keys)
    return rows.select("client_id", "branch", "band")


@query
def latest_per_key(m):
    columns = ["seller", "segment", "email"]
    return joins.latest_values(m.raw, ["client_id", "branch"], columns, "sale_date")


# Reshaping and features


@query
def union_tagged(m):
    end = m.end
    cuts = {"Training": F.add_months(end, -3), "Production": end}
    rows = features.features_for_cuts(m.activity, cuts)
    return rows.select("data_type", *KEYS, "monetary_value", "frequency", "recency", "max_gap")


@query
def unpivot_margin(m):
    wide = m.margins.groupBy("product").pivot("branch", list(s.REGIONS)).agg(
        F.max("margin")
    )
    table = wide.withColumnRenamed("product", "Prod_Family_level3")
    return rounded(margins.unpivot_margin(table, "Prod_Family_level3"), 6, "margin")


@query
def one_hot(m):
    rows = m.lines.select(*LINE, "product", "branch")
    encoded = features.one_hot(rows, {"product": s.TYPES, "branch": s.REGIONS})
    marks = [c for c in encoded.columns if c not in rows.columns]
    return longs(encoded.select(*LINE, *marks), *marks).withColumnsRenamed(
        {c: c.lower().replace(" ", "_") for c in marks}
    )


@query
def quantile_sketch(m):
    """Quantiles of a branch's monthly sketches, merged: the exact one, and whether the rank
    of the sketch's lies within the bound stated."""
    probs, value = (0.001, 0.25, 0.5, 0.75, 0.999), "monetary_value"
    rows = m.activity
    monthly = store(sketches.quantile_sketches(rows, [value], ["branch", "period"]), "sketches")
    merged = sketches.merge_sketches(monthly, ["branch"])
    found = store(sketches.sketch_quantiles(merged, probs), "quantiles")
    exact = quantiles.order_statistics(rows, [value], probs, "branch")
    known = m.spark.createDataFrame(
        [(g, p, quantiles.interpolate(*v)) for (g, _, p), v in exact.items()],
        "branch string, prob double, exact double",
    )
    ranked = F.broadcast(found.withColumnRenamed("value", "_q"))  # branches times quantiles
    ranks = (
        rows.join(ranked, "branch")
        .groupBy("branch", "prob", "n")
        .agg(
            F.count_if(F.col(value) < F.col("_q")).alias("below"),
            F.count_if(F.col(value) <= F.col("_q")).alias("upto"),
        )
    )
    wanted, most = F.col("prob") * F.col("n"), sketches.rank_error() * F.col("n") + 1
    within = (F.col("below") <= wanted + most) & (F.col("upto") >= wanted - most)
    out = ranks.join(known, ["branch", "prob"]).select(
        "branch", "prob", "n", "exact", within.alias("within")
    )
    return rounded(out, 4, "exact")


@query
def cap_floor(m):
    rows = quantiles.cap_floor(store(m.features, "features"), ["monetary_value", "volume"], 0.999, 0.001)
    return rounded(rows.select(*KEYS, "monetary_value", "volume"), 4, "monetary_value", "volume")


@query
def risk_level(m):
    return m.risk_plan.select(
        *KEYS, "frequency", "last_purchase", "churn_probability", "risk_level"
    )


@query
def balance_classes(m):
    rows = sampling.balance_classes(store(m.training, "training"))
    return longs(rows.select(*KEYS, "frequency", "target"), "target")


@query
def train_test_split(m):
    return sampling.split_by_hash(m.training).select(*KEYS, "part")


# Metrics


def _predicted(m) -> DataFrame:
    rows = m.training.withColumn("churn_probability", s.synthetic_probability())
    return metrics.with_prediction(sampling.frequent(rows))


@query
def classification_report(m):
    rows = metrics.classification_report(_predicted(m))
    return rounded(rows, 6, "precision", "recall", "f1_score", "support")


@query
def auc_hard_label(m):
    return rounded(metrics.auc_of_labels(_predicted(m)), 6, "auc")


@query
def churn_rate(m):
    rows = metrics.churn_rate(m.training)
    return rounded(rows, 6, "churn_rate", "loyal_rate")


# Client list and targets

LIST_COLUMNS = (
    "client_id", "branch", "client_name", "segment", "seller", "phone", "email", "sales_12m",
    "client_churn_probability", "client_margin_est", "expected_loss", "potential_win",
)


def _list_columns(df: DataFrame, *more: str) -> DataFrame:
    df = rounded(df.select(*LIST_COLUMNS, *more), 6, "client_churn_probability", "client_margin_est")
    return rounded(df, 2, "expected_loss")


@query
def client_list(m):
    return _list_columns(m.clients)


@query
def topk_opportunities(m):
    rows = m.opportunities
    return rounded(rows, 6, "margin").select("client_id", "client_name", "total_value", "margin")


@query
def client_targets(m):
    return _list_columns(m.targets)


@query
def target_detail(m):
    graded = m.risk
    rows = targeting.target_detail(graded, m.targets)
    return rows.select(*KEYS, "risk_level", "churn_probability", "total_value")


def _sorted_targets(m) -> DataFrame:
    # Rounded before sorting, so that both engines order equal values alike.
    return _list_columns(m.targets)


@query
def rank_clients(m):
    rows = targeting.rank_clients(_sorted_targets(m))
    return rows.select("call_rank", "client_id", "branch", "expected_loss")


@query
def row_number(m):
    order = [F.col("amount").desc(), F.col("order_no"), F.col("line_no")]
    rows = m.raw.select(*LINE, "amount")
    return ranking.global_row_number(rows, order)


@query
def carry_over(m):
    rows = targeting.carry_over(m.targets, m.last_list)
    return rows.select("client_id", "branch", *NOTE_COLUMNS)


# Assignment

SHARES = {"agent one": 0.3, "agent two": 0.45, "agent three": 0.25}


@query
def assign_threshold(m):
    rows = assign.with_seller(
        m.clients.drop("seller"), _seller_table(m), s.LABELS.no_seller
    )
    rows = assign.assign_by_limit(rows, 150000)
    return rows.select("client_id", "branch", "seller", "sales_12m", "assignee")


def _seller_table(m) -> DataFrame:
    """A seller for part of the clients."""
    rows = m.table("supplier").where(F.col("s_acctbal") > 1000)
    return rows.select(
        F.col("s_suppkey").alias("client_id"),
        F.concat(F.lit("V"), F.col("s_nationkey").cast("string")).alias("seller"),
    )


def _centre_clients(m) -> DataFrame:
    rows = m.table("supplier").where(F.col("s_acctbal") < 6000)
    return rows.select(F.col("s_suppkey").alias("client_id"))


def _listed(m) -> DataFrame:
    return assign.assign_by_list(m.clients, _centre_clients(m))


@query
def assign_list(m):
    return _listed(m).select("client_id", "branch", "seller", "assignee")


@query
def allocate_shares(m):
    rows = assign.allocate_shares(store(_listed(m), "listed"), SHARES)
    return rows.select("client_id", "branch", "assignee")


@query
def assign_quota(m):
    rows = assign.assign_quota(store(m.clients, "clients"), 0.8, 10, 40, ("3-MEDIUM",))
    return rows.select("client_id", "branch", "seller", "sales_12m", "assignee")


# Sinks


@query
def sink_roundtrip(m):
    path, rows = scratch_path(m.spark, "sink"), _monthly_results(m)
    for _ in range(2):  # a rerun must leave the same table
        publish.write_result(rows, path)
    return read_table(m.spark, TableRef(path, schema=rows.schema))


RESULT_TABLES = ("client_list", "product_risk", "risk_view", "history_view", "metrics")


@query
def sink_commit(m):
    """Five tables after a month that is published, after one that fails behind the third
    table, and after that month's second try: what readers see each time."""
    path, rows = scratch_path(m.spark, "published"), store(_monthly_results(m), "results")

    def outputs(period, broken=False):
        month = rows.where(F.col("period") == period)
        tables = {name: month.withColumn("kind", F.lit(name)) for name in RESULT_TABLES}
        if broken:
            failing = F.when(F.raise_error(F.lit("disk lost")).isNull(), F.col("kind"))
            tables["history_view"] = tables["history_view"].withColumn("kind", failing)
        return {
            name: commit.Output(df, not name.endswith("_view"), name == "metrics")
            for name, df in tables.items()
        }

    def seen(state):
        frames = [
            commit.read_published(m.spark, path, name).withColumn("table", F.lit(name))
            for name in RESULT_TABLES
        ]
        both = reduce(DataFrame.unionByName, frames).withColumn("state", F.lit(state))
        return store(
            both.groupBy("state", "table", "country", "period").agg(
                F.count(F.lit(1)).alias("rows"),
                val.exact_sum(F.col("monetary_value")).alias("monetary_value"),
            ),
            "seen",
        )

    commit.publish(m.spark, path, "xx", outputs("200106"))
    states = [seen("first")]
    try:
        commit.publish(m.spark, path, "xx", outputs("200107", broken=True))
    except Exception as error:  # the engine's own, which wraps the message
        if "disk lost" not in str(error):
            raise
    else:
        raise AssertionError("the broken table was written")
    states.append(seen("failed"))
    commit.publish(m.spark, path, "xx", outputs("200107"))
    commit.vacuum(m.spark, path, "xx", keep=1)
    states.append(seen("second"))
    return reduce(DataFrame.unionByName, states)


def _drop_list(df: DataFrame, folder: str, names=None) -> None:
    """Write a list as the countries hand it in: text, a folder per country."""
    df = df.withColumns({c: F.col(c).cast("string") for c in ("client_id", "row_no")})
    (
        df.select(*(names or ("client_id", "row_no", *NOTE_COLUMNS)), "country")
        .write.mode("append")
        .partitionBy("country")
        .option("header", "true")
        .option("nullValue", "\\N")
        .csv(folder)
    )


@query
def feedback_quarantine(m):
    """Two loads: in the second one country's file lacks columns, one of another's two files
    does, and a third has its columns the other way round."""
    first, second = scratch_path(m.spark, "drop"), scratch_path(m.spark, "drop")
    target = scratch_path(m.spark, "last")
    rows = store(m.last_list.withColumnRenamed("branch", "country"), "oldlist")
    _drop_list(rows.withColumn("Estado", F.lit("old")), first)
    publish.load_feedback(read_feedback(m.spark, first), target)
    country = F.col("country")
    names = ("client_id", "row_no", *NOTE_COLUMNS)
    few = names[:-2]
    _drop_list(rows.where(country == "AMERICA"), second, few)
    _drop_list(rows.where((country == "EUROPE") & (F.col("client_id") % 2 == 0)), second)
    _drop_list(rows.where((country == "EUROPE") & (F.col("client_id") % 2 == 1)), second, few)
    _drop_list(rows.where(country == "ASIA"), second, tuple(reversed(names)))
    _drop_list(rows.where(country.isin("AFRICA", "MIDDLE EAST")), second)
    publish.load_feedback(read_feedback(m.spark, second), target)
    ordered = rows.select("client_id", "row_no", *NOTE_COLUMNS, "country")
    loaded = read_table(m.spark, TableRef(target, schema=ordered.schema))
    held = m.spark.read.parquet(f"{target}_quarantine")
    reasons = held.where(F.col("reason").startswith("lacks")).groupBy("country")
    return loaded.join(reasons.agg(F.min("reason").alias("reason")), "country", "left")


@query
def feedback_load(m):
    folder, target = scratch_path(m.spark, "drop"), scratch_path(m.spark, "last")
    rows = store(m.last_list.withColumnRenamed("branch", "country"), "oldlist")
    # As exported: columns in another order, and one that the load does not know.
    as_text = rows.select(
        F.lit("x").alias("band"), *NOTE_COLUMNS, F.col("client_id").cast("string").alias("client_id"),
        F.col("row_no").cast("string").alias("row_no"), "country",
    )
    broken = as_text.dropDuplicates(["country"]).withColumn("client_id", F.lit("no number"))
    (
        as_text.unionByName(broken)
        .write.partitionBy("country")
        .option("header", "true")
        .option("nullValue", "\\N")
        .csv(folder)
    )
    bad = publish.load_feedback(read_feedback(m.spark, folder), target)
    ordered = rows.select("client_id", "row_no", *NOTE_COLUMNS, "country")
    loaded = read_table(m.spark, TableRef(target, schema=ordered.schema))
    rejected = bad.groupBy("country").agg(F.count(F.lit(1)).alias("rejected"))
    return loaded.join(rejected, "country", "left")


@query
def export_bands(m):
    path = scratch_path(m.spark, "export")
    keys = ["client_id", "branch"]
    graded = m.risk
    banded = rollup.band_clients(m.clients, graded, keys).select(
        "client_id", "client_name", "seller", "band", F.col("branch").alias("country")
    )
    publish.export_tables({"clients": banded}, path)
    return (
        m.spark.read.schema(banded.schema).option("header", "true").csv(f"{path}/clients")
    )


# Model

# The default search but for forests of hundreds of trees, which are smaller than the reference's,
# and smaller samples, which only the queries of samples and rungs draw.
GRID = model.SearchGrid(trees=(100, 200, 300), least_rows=64, parallelism=8)
# Every draw whole: all its trees, on all rows of every fold.
WHOLE = replace(GRID, rungs=1)
FEW = replace(WHOLE, draws=6, folds=3)
# No search, for queries that show what comes after it.
ONE = model.SearchGrid(
    trees=(300,), depths=(10,), leaf_rows=(1,), bootstrap=(True,), draws=1, folds=2, rungs=1
)


def _model_rows(m):
    """Training rows with their label, and production rows, both with attributes."""
    m.share_raw()
    end = m.end
    attributes = joins.latest_values(
        m.raw, ["client_id", "product"], ["segment"], "sale_date"
    )
    cuts = {"Training": F.add_months(end, -3), "Production": end}
    both = features.features_for_cuts(m.activity, cuts)
    both = joins.join_back(both, attributes, ["client_id", "product"], "inner")
    both = store(
        quantiles.cap_floor(both, ["monetary_value", "volume"], 0.999, 0.001, "data_type"),
        "features",
    )
    training = store(
        features.attach_label(
            both.where(F.col("data_type") == "Training"), m.labels
        ),
        "labelled",
    )
    return both, training


def _calibrated(m, grid, label=None):
    both, training = _model_rows(m)
    if label:
        training = label(training)
    encoder = model.fit_encoder(both, s.MARKET.categories)
    fitted = model.calibrate(encoder, training, grid=grid)
    return fitted, training, both.where(F.col("data_type") == "Production")


@query
def model_calibrate(m):
    """Every draw with its accuracy over four folds of all training rows, fitted whole."""
    fitted, _, _ = _calibrated(m, WHOLE)
    return m.spark.createDataFrame(fitted.search)


@query
def model_score(m):
    fitted, _, production = _calibrated(m, ONE)
    scored = model.score(fitted, production)
    return scored.select(*KEYS, "frequency", "churn_probability")


@query
def model_metrics(m):
    fitted, training, _ = _calibrated(m, ONE)
    return model.evaluate(fitted, training)


@query
def model_samples(m):
    """The nested samples of the search: the first rung that holds each row, and its fold."""
    rows = sampling.balance_classes(m.training)
    train = sampling.split_by_hash(rows).where(F.col("part") == "train")
    return model.rung_samples(store(train, "balanced"), GRID).select(*KEYS, "target", "fold", "rung")


@query
def model_rungs(m):
    """What each rung fits: how many draws, and on how many rows."""
    rows = sampling.balance_classes(m.training)
    train = store(sampling.split_by_hash(rows).where(F.col("part") == "train"), "balanced")
    sampled = store(model.rung_samples(train, GRID), "sampled")
    kept = m.spark.createDataFrame(
        list(enumerate(GRID.survivors())), "rung int, draws int"
    )
    counts = sampled.select(F.col("rung").alias("_first"), "target")
    return (
        kept.join(F.broadcast(counts.groupBy("_first").agg(
            F.count(F.lit(1)).alias("_n"), F.sum("target").alias("_t"))), F.col("_first") <= F.col("rung"))
        .groupBy("rung", "draws")
        .agg(F.sum("_n").alias("rows"), F.sum("_t").cast("long").alias("churners"))
    )


def _planted(rows):
    """A label that the features decide, so that SQL knows what a model must find."""
    return rows.withColumn("target", (F.col("frequency") >= 5).cast("int"))


@query
def model_learns(m):
    """The test rows of a search whose label the features decide: label and prediction."""
    fitted, _, _ = _calibrated(m, FEW, _planted)
    scored = model.score(model.ChurnModel(fitted.encoder, fitted.held_out), fitted.test)
    return metrics.with_prediction(scored).select(*KEYS, "frequency", "target", "prediction")


@query
def model_reload(m):
    """A model fitted and stored, then loaded and used: its predictions, and whether its
    probabilities are those from before."""
    rows = store(_planted(m.training_features.where(F.col("frequency") > 3)), "planted")
    encoder = model.fit_encoder(rows, ["branch", "product"])
    params = dict(numTrees=200, maxDepth=10, minInstancesPerNode=1, bootstrap=True)
    fitted = model.fit_forest(encoder, rows, params)
    path = scratch_path(m.spark, "model")
    model.save_model(fitted, path)
    before = model.score(fitted, rows).select(*KEYS, F.col("churn_probability").alias("before"))
    after = metrics.with_prediction(model.score(model.load_model(path), rows))
    same = F.abs(F.col("churn_probability") - F.col("before")) < 1e-12
    return joins.join_back(after, before, list(KEYS), "inner").select(
        *KEYS, "frequency", "prediction", same.alias("same")
    )


@query
def category_codes(m):
    """Codes of a few and of many values; rare ones share a code, as does null."""
    columns = ["product", "segment", "client_name"]
    m.share_raw()
    dictionary = store(categories.category_dictionary(m.raw, columns, 20, 60), "dictionary")
    sizes = categories.dictionary_sizes(dictionary, columns)
    coded = categories.encode_categories(m.raw, dictionary, sizes)
    return coded.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("lines"),
        *[F.max(categories.code_name(c)).cast("long").alias(f"{c}_code") for c in columns],
    )


@query
def category_dictionary(m):
    return categories.category_dictionary(m.raw, ["product", "client_name"], 20, 60)


@query
def mid_ranks(m):
    rows = m.training.withColumn("churn_probability", s.synthetic_probability())
    return roc.mid_ranks(rows, "churn_probability").select(*KEYS, "churn_probability", "mid_rank")


@query
def score_auc(m):
    rows = m.training.withColumn("churn_probability", s.synthetic_probability())
    found = roc.roc_auc(rows, "churn_probability")
    return found.withColumn("auc", val.round_half_even(F.col("auc"), 9))
