"""The monthly run of one market: raw lines to a call list and its reporting tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators import assign, model
from holdfast.operators import publish as views
from holdfast.operators.activity import monthly_activity, newest_period, sales_total
from holdfast.operators.commit import Output, publish
from holdfast.operators.features import attach_label, features_for_cuts, label_window
from holdfast.operators.increments import MonthlyParts
from holdfast.operators.joins import join_back, latest_values, lookup
from holdfast.operators.margins import join_margin, unpivot_margin
from holdfast.operators.prepare import prepare_sales, scope_sales, set_flags
from holdfast.operators.quantiles import cap_floor
from holdfast.operators.risk import buy_probability, classify_risk, with_total_value
from holdfast.operators.rollup import client_names, client_rollup, risk_counts
from holdfast.operators.targeting import (
    carry_over,
    client_branch_profile,
    client_list,
    client_sellers,
    rank_clients,
    select_targets,
    target_detail,
    top_opportunities,
)
from holdfast.session import owned_tables, store
from holdfast.sources.feedback import NOTE_COLUMNS
from holdfast.sources.tables import trailing_months
from holdfast.spec import MarketSpec

TRAINING, PRODUCTION = "Training", "Production"


@dataclass
class Inputs:
    """What one market's run reads.

    ``tables`` holds the dimension tables by the names used in the market's lookups, and, for
    markets that use them, ``sellers`` (client_id, seller), ``margins`` (cross table) and
    ``centre_clients`` (client_id).
    """

    sales: DataFrame
    tables: Mapping[str, DataFrame] = field(default_factory=dict)
    last_list: DataFrame | None = None
    agents: Mapping[str, float] = field(default_factory=dict)


@dataclass
class Results:
    client_list: DataFrame
    product_risk: DataFrame
    risk_view: DataFrame
    history_view: DataFrame
    metrics: DataFrame | None
    counts: DataFrame
    stored: list[str] = field(default_factory=list)  # for ``release_stored``

    def tables(self) -> dict[str, DataFrame]:
        found = {
            "client_list": self.client_list,
            "product_risk": self.product_risk,
            "risk_view": self.risk_view,
            "history_view": self.history_view,
            "metrics": self.metrics,
        }
        return {name: df for name, df in found.items() if df is not None}


Scorer = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame | None]]


def forest_scorer(
    spec: MarketSpec, grid: model.SearchGrid = model.SearchGrid(rungs=1), save_to: str | None = None
) -> Scorer:
    """Train on labelled rows, evaluate on a held-out part, score the production rows."""

    def run(training: DataFrame, production: DataFrame):
        both = training.drop("target").unionByName(production)
        encoder = model.fit_encoder(both, spec.categories, spec.numeric)
        fitted = model.calibrate(encoder, training, spec.rules, grid)
        if save_to:
            model.save_model(fitted, save_to)
        metrics = model.evaluate(fitted, training, spec.rules)
        return model.score(fitted, production), metrics

    return run


def stored_scorer(path: str) -> Scorer:
    """Score with a model saved by an earlier run."""
    return lambda training, production: (model.score(model.load_model(path), production), None)


def source_lines(spec: MarketSpec, sales: DataFrame, as_of: dt.date) -> DataFrame:
    """The history window, tested on the raw date column so that the source filters."""
    date = spec.columns.get("history_date", spec.columns["sale_date"])
    pattern = None if spec.history_date == "history_date" else spec.date_pattern
    return trailing_months(
        sales, date, as_of, spec.windows.history, pattern, spec.history_after
    )


def _attributes(spec: MarketSpec, raw: DataFrame, scoped: DataFrame) -> DataFrame | None:
    """One row of attributes per key, so that the join repeats no feature row."""
    if not spec.attributes:
        return None
    source = scoped if spec.attributes_scoped or spec.attributes_remapped else raw
    found = latest_values(source, spec.attribute_keys, spec.attributes, "sale_date")
    return set_flags(found.na.drop(subset=list(spec.required_attributes)), spec.flags)


def model_rows(
    spec: MarketSpec, raw: DataFrame, scoped: DataFrame, activity: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Labelled training rows and production rows, capped and with attributes.

    Training ends before the label months, so no feature sees them.
    """
    end = newest_period(activity)
    cuts = {TRAINING: F.add_months(end, -spec.windows.label), PRODUCTION: end}
    both = features_for_cuts(activity, cuts, spec.windows, spec.gap_by_branch)
    limited = [*spec.measures, "volume"]
    both = cap_floor(
        store(both, "features"), limited, spec.rules.cap, spec.rules.floor, "data_type"
    )
    attributes = _attributes(spec, raw, scoped)
    if attributes is not None:
        both = join_back(both, attributes, spec.attribute_keys, "inner")
    both = store(both, "modelrows")
    labels = label_window(activity, end, spec.windows.label, spec.label_by_branch)
    training = attach_label(
        both.where(F.col("data_type") == TRAINING), labels, spec.label_by_branch
    )
    return store(training, "labelled"), both.where(F.col("data_type") == PRODUCTION)


RISK_COLUMNS = (
    "client_name",
    "client_id",
    "branch",
    "product",
    "churn_probability",
    "analysis_period",
    "last_purchase",
    "frequency",
    "volume",
    "mean_gap",
    "max_gap",
)


def grade(spec: MarketSpec, scored: DataFrame, raw: DataFrame, inputs: Inputs) -> DataFrame:
    """Risk rows with client name, margin and total value."""
    named = join_back(scored, client_names(raw), ["client_id"]).select(
        *RISK_COLUMNS, *spec.measures
    )
    if spec.margin_table:
        margins = unpivot_margin(inputs.tables["margins"], "Prod_Family_level3")
        named = join_margin(named, store(margins, "margins"))
    else:
        named = named.withColumn("margin", F.lit(0.0))
    return with_total_value(classify_risk(named, spec.rules, spec.labels))


def build_client_list(
    spec: MarketSpec, risk: DataFrame, raw: DataFrame, scoped: DataFrame, inputs: Inputs
) -> DataFrame:
    months, rules = spec.windows.sales_total, spec.sales_total_rules
    listed = scoped if spec.list_scoped else raw
    profile = client_branch_profile(listed, spec.list_columns, spec.list_branch, months, rules)
    extras = []
    if spec.list_scoped != spec.sales_total_scoped:
        # Totals come from other lines than the attributes do.
        profile = profile.drop("sales_12m")
        source = scoped if spec.sales_total_scoped else raw
        extras.append(sales_total(source, months, spec.list_branch, rules=rules))
    if spec.seller_from == "client":
        extras.append(client_sellers(raw))
    if spec.contact_columns:
        extras.append(
            latest_values(scoped, ["client_id", "branch"], spec.contact_columns, "sale_date")
        )
    clients = client_list(client_rollup(risk, spec.rules, spec.labels), profile, *extras)
    if spec.seller_from == "table":
        sellers = inputs.tables["sellers"].distinct()
        clients = assign.with_seller(clients, sellers, spec.labels.no_seller)
    # As text, so that one table can hold every market's list.
    as_text = [*spec.list_columns, *spec.contact_columns]
    return clients.withColumns({c: F.col(c).cast("string") for c in as_text})


def assign_callers(spec: MarketSpec, targets: DataFrame, inputs: Inputs) -> DataFrame:
    """Own seller or call centre, then named agents for the centre's clients."""
    centre = spec.labels.centre
    if spec.seller_limit is not None:
        targets = assign.assign_by_limit(targets, spec.seller_limit, centre)
    if spec.call_centre:
        targets = assign.assign_by_list(targets, inputs.tables["centre_clients"], centre)
        if inputs.agents:
            targets = assign.allocate_shares(store(targets, "assigned"), inputs.agents)
    return targets


def build_risk_view(
    spec: MarketSpec, risk: DataFrame, raw: DataFrame, scoped: DataFrame
) -> DataFrame:
    extras = [latest_values(scoped, keys, cols, "sale_date") for keys, cols in spec.views]
    source = scoped if spec.sales_total_scoped else raw
    extras.append(
        sales_total(
            source, spec.windows.sales_total, spec.list_branch, rules=spec.sales_total_rules
        )
    )
    if spec.flags or spec.attributes_scoped:
        taken = {c for _, cols in spec.views for c in cols}
        attributes = _attributes(spec, raw, scoped)
        extras.append(attributes.drop(*taken))
    return views.risk_view(risk.drop("total_value"), *extras)


def build_history_view(
    spec: MarketSpec, raw: DataFrame, scoped: DataFrame, inputs: Inputs, as_of: dt.date
) -> DataFrame:
    df = views.history_view(raw, as_of, spec.history_date, spec.history_rules)
    for item in spec.lookups:
        if item.table in spec.history_lookups:
            df = lookup(df, inputs.tables[item.table], item)
    if spec.history_segment:
        segments = latest_values(scoped, ["client_id"], ["segment"], "sale_date")
        df = join_back(df, segments, ["client_id"])
    return df.drop(*spec.history_drop)


def no_list(clients: DataFrame) -> DataFrame:
    """An empty last list, for a first run: all notes are blank then."""
    notes = [F.lit(None).cast("string").alias(c) for c in NOTE_COLUMNS]
    row_no = F.lit(None).cast("long").alias("row_no")
    return clients.select("client_id", row_no, *notes).where(F.lit(False))


def run_month(
    spec: MarketSpec, inputs: Inputs, as_of: dt.date, scorer: Scorer | None = None
) -> Results:
    """Run one market for the month before ``as_of``.

    Lines, activity and risk rows feed several steps and are stored in the scratch folder,
    as are the dimension tables, whose size the planner then knows; everything else is one
    plan per result table.  What the run stored is listed in the result's ``stored``.
    """
    with owned_tables() as stored:
        results = _run_month(spec, inputs, as_of, scorer or forest_scorer(spec))
    results.stored = stored
    return results


def _run_month(spec: MarketSpec, inputs: Inputs, as_of: dt.date, scorer: Scorer) -> Results:
    tables = {name: store(df, f"table-{name}") for name, df in inputs.tables.items()}
    inputs = replace(inputs, tables=tables)
    raw = store(
        prepare_sales(source_lines(spec, inputs.sales, as_of), spec, inputs.tables), "lines"
    )
    scoped = scope_sales(raw, spec, inputs.tables)
    if spec.lookups or spec.remap or spec.drop_duplicate_lines:
        scoped = store(scoped, "scoped")
    activity = store(monthly_activity(scoped, spec.measures), "activity")
    training, production = model_rows(spec, raw, scoped, activity)
    scored, metrics = scorer(training, production)
    risk = store(grade(spec, scored, raw, inputs), "risk")
    clients = store(build_client_list(spec, risk, raw, scoped, inputs), "clients")
    newest = newest_period(scoped if spec.opportunity_cut_scoped else raw)
    top = top_opportunities(risk, newest, spec.windows, spec.rules, spec.labels)
    targets = select_targets(clients, top, spec.excluded_sellers).drop("has_risk")
    detail = buy_probability(target_detail(risk, targets), spec.labels).drop("total_value")
    old = no_list(targets) if inputs.last_list is None else inputs.last_list
    targets = carry_over(targets, old, spec.labels)
    targets = rank_clients(store(assign_callers(spec, targets, inputs), "targets"))
    month = F.lit(as_of).cast("date")
    period = F.date_format(F.add_months(month, -1), "yyyyMM")

    def tagged(df: DataFrame) -> DataFrame:
        return df.withColumns({"country": F.lit(spec.code), "period": period})

    if metrics is not None:
        metrics = metrics.withColumn("country_name", F.lit(spec.country))

    history = build_history_view(spec, raw, scoped, inputs, as_of)
    return Results(
        client_list=tagged(targets.withColumn(spec.period_column, period)),
        product_risk=tagged(detail),
        risk_view=tagged(build_risk_view(spec, risk, raw, scoped)),
        history_view=tagged(history.withColumnRenamed("period", "sale_period")),
        metrics=None if metrics is None else tagged(metrics),
        counts=risk_counts(clients, spec.rules.at_risk),
    )


def publish_month(spec: MarketSpec, results: Results, root: str) -> int:
    """Publish the result tables by country and month in one commit, see ``operators.commit``;
    a rerun replaces that month's rows only.  Read them with ``read_published``.

    The views carry the market's own columns, so each market has its own folder for them.
    """
    tables = {
        name: Output(df, not name.endswith("_view"), name in spec.newest_only)
        for name, df in results.tables().items()
    }
    return publish(results.client_list.sparkSession, root, spec.code, tables)


def load_parts(spec: MarketSpec, inputs: Inputs, parts: MonthlyParts, lines: DataFrame) -> None:
    """Take whole months of a market's raw lines into its monthly sums."""
    raw = store(prepare_sales(lines, spec, inputs.tables), "lines")
    scoped = scope_sales(raw, spec, inputs.tables)
    parts.load(scoped, scoped if spec.sales_total_scoped else raw)


def market_parts(spec: MarketSpec, spark: SparkSession, root: str) -> MonthlyParts:
    """A market's monthly sums under ``root``."""
    return MonthlyParts(
        spark, f"{root}/{spec.code}", spec.measures, spec.sales_total_rules, spec.list_branch
    )
