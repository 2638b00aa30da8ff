"""The supplied order tables as a market: invoice lines in role columns and derived tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.hashing import digest_number, key_digest
from holdfast.functions.predicates import apply_rules
from holdfast.functions.values import exact_sum, ratio
from holdfast.operators.activity import monthly_activity, newest_period, with_gaps
from holdfast.operators.features import attach_label, build_features, label_window
from holdfast.operators.joins import join_back, latest_values
from holdfast.operators.margins import join_margin
from holdfast.operators.risk import classify_risk, with_total_value
from holdfast.operators.rollup import client_names, client_rollup
from holdfast.operators.targeting import (
    client_branch_profile,
    client_list,
    client_sellers,
    select_targets,
    top_opportunities,
)
from holdfast.sources.tables import TableRef, read_table, trailing_months
from holdfast.session import store
from holdfast.spec import KEYS, MarketSpec, RiskLabels, Rule

AS_OF = "2001-09-01"
LABELS = RiskLabels()

MARKET = MarketSpec(
    code="xx",
    country="Testland",
    columns={},
    scope_rules=(Rule("product", "not_null"),),
    attribute_keys=("client_id", "product"),
    attributes=("segment", "flag_a", "flag_b"),
    flags=("flag_a", "flag_b"),
    list_columns=("segment",),
    views=((KEYS, ("segment", "seller")),),
    categories=("branch", "product", "segment"),
    excluded_sellers=("5-LOW",),
    margin_table=True,
)

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")


LINE_ONLY = ("order_no", "line_no", "product_code", "size_code", "doc_type", "data_kind")

# Declared, so that no job reads file footers to find them.
SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, TableRef(f"{folder}/{name}.parquet", schema=SCHEMAS[name]))


def sales_lines(spark: SparkSession, folder: str, months: int | None = None) -> DataFrame:
    """Invoice lines; with ``months`` the window is tested on the order date at its scan."""
    orders = table(spark, folder, "orders")
    if months:
        orders = trailing_months(orders, "o_orderdate", AS_OF, months)
    return lines_of(spark, folder, orders)


def lines_of(spark: SparkSession, folder: str, orders: DataFrame) -> DataFrame:
    """The invoice lines of some orders."""
    c = F.col
    # Small tables are joined to each other and to the orders first, so the lines, the
    # largest table, take part in as few exchanges as possible.
    places = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), c("c_nationkey") == c("n_nationkey"))
        .join(table(spark, folder, "region"), c("n_regionkey") == c("r_regionkey"))
    )
    placed = orders.join(places, c("o_custkey") == c("c_custkey"))
    return (
        table(spark, folder, "lineitem")
        .join(placed, c("l_orderkey") == c("o_orderkey"))
        .join(table(spark, folder, "part"), c("l_partkey") == c("p_partkey"))
        .join(table(spark, folder, "supplier"), c("l_suppkey") == c("s_suppkey"))
        .select(
            c("l_orderkey").alias("order_no"),
            c("l_linenumber").cast("long").alias("line_no"),
            c("l_suppkey").alias("client_id"),
            F.nullif(c("p_type"), F.lit("PROMO")).alias("product"),
            c("l_partkey").alias("product_code"),
            c("p_size").cast("long").alias("size_code"),
            c("r_name").alias("branch"),
            c("o_orderdate").cast("date").alias("sale_date"),
            F.trunc("o_orderdate", "month").alias("period"),
            (c("l_extendedprice") * (F.lit(1) - c("l_discount"))).alias("amount"),
            c("l_extendedprice").alias("amount_usd"),
            c("l_quantity").alias("volume"),
            c("s_name").alias("client_name"),
            c("o_orderpriority").alias("seller"),
            c("c_mktsegment").alias("segment"),
            c("l_returnflag").alias("doc_type"),
            c("l_linestatus").alias("data_kind"),
            F.when(c("s_acctbal") > 5000, "S").when(c("s_acctbal") > 2000, "N").alias("flag_a"),
            F.when(c("l_returnflag") == "R", "S").otherwise(c("l_returnflag")).alias("flag_b"),
            F.concat(F.lit("T"), c("n_name")).alias("phone"),
            F.when(
                c("l_linestatus") == "O", F.concat(F.lit("m"), c("o_custkey").cast("string"))
            ).alias("email"),
        )
    )


def synthetic_probability() -> Column:
    """A probability fixed by the key, in place of a fitted model."""
    return (digest_number(key_digest(KEYS, 5), 6) % 1000) / F.lit(1000.0)


class Tables:
    """The steps of one query.

    Lines and activity that several steps read are stored once per query, as the monthly run
    does; nothing is kept between queries.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    @property
    def lines(self) -> DataFrame:
        return sales_lines(self.spark, self.folder)

    @cached_property
    def raw(self) -> DataFrame:
        """The lines of the 27-month window."""
        return sales_lines(self.spark, self.folder, MARKET.windows.history)

    def share_raw(self) -> None:
        """Store the lines, for queries that read them in several steps; the columns that
        only single-step queries use stay out."""
        if "raw" not in self.__dict__:
            self.raw = store(self.raw.drop(*LINE_ONLY), "lines")

    @property
    def scoped(self) -> DataFrame:
        return apply_rules(self.raw, MARKET.scope_rules)

    @property
    def activity_plan(self) -> DataFrame:
        return monthly_activity(self.scoped, MARKET.measures)

    @cached_property
    def activity(self) -> DataFrame:
        return store(self.activity_plan, "activity")

    @property
    def gaps(self) -> DataFrame:
        return with_gaps(self.activity)

    @cached_property
    def end(self) -> Column:
        """The newest month in scope."""
        return newest_period(self.activity)

    @property
    def training_end(self) -> Column:
        return F.add_months(self.end, -MARKET.windows.label)

    @property
    def features(self) -> DataFrame:
        return build_features(self.activity, self.end)

    @property
    def labels(self) -> DataFrame:
        return label_window(self.activity, self.end)

    @property
    def training_features(self) -> DataFrame:
        return build_features(self.activity, self.training_end)

    @cached_property
    def training(self) -> DataFrame:
        return attach_label(self.training_features, self.labels)

    @cached_property
    def margins(self) -> DataFrame:
        """A margin per product and branch, from list price against price paid; stored, so
        that its size is known to the joins."""
        paid, listed = exact_sum(F.col("amount")), exact_sum(F.col("amount_usd"))
        share = F.lit(1.0) - ratio(paid, listed)
        margins = self.scoped.groupBy("product", "branch").agg(share.alias("margin"))
        return store(
            margins.where((F.col("product") != "ECONOMY") | (F.col("branch") != "ASIA")), "margins"
        )

    @property
    def risk_plan(self) -> DataFrame:
        self.share_raw()
        scored = self.features.withColumn("churn_probability", synthetic_probability())
        graded = classify_risk(join_back(scored, client_names(self.raw), ["client_id"]))
        return with_total_value(join_margin(graded, self.margins))

    @cached_property
    def risk(self) -> DataFrame:
        return store(self.risk_plan, "risk")

    @property
    def clients(self) -> DataFrame:
        """The client list, from stored risk rows where another step stored them."""
        self.share_raw()
        contacts = latest_values(
            self.scoped, ["client_id", "branch"], ["phone", "email"], "sale_date"
        )
        return client_list(
            client_rollup(self.risk if "risk" in self.__dict__ else self.risk_plan),
            client_branch_profile(self.raw, ["segment"]),
            client_sellers(self.raw),
            contacts,
        )

    @property
    def opportunities(self) -> DataFrame:
        return top_opportunities(self.risk, self.end)

    @property
    def targets(self) -> DataFrame:
        top = self.opportunities  # stores the risk rows, which the clients then use
        return select_targets(self.clients, top, MARKET.excluded_sellers)

    @property
    def last_list(self) -> DataFrame:
        """Last month's edited list: a row per client and branch, notes made from hashes."""
        keys = self.raw.select("client_id", "branch").distinct()
        h = F.col("_h")
        mark = F.concat_ws("-", F.lit("n"), F.col("client_id").cast("string"), F.col("branch"))
        note = {
            "Estado": F.when(h % 4 != 0, F.concat(F.lit("E"), (h % 5).cast("string"))),
            "Fecha_planificada": mark,
            "telefono_alternativo": F.when(h % 2 == 0, mark),
            "nombre_persona_contactada": mark,
            "motivo_contacto_fallido": F.when(h % 3 == 0, LABELS.not_at_risk_reason).when(
                h % 3 == 1, "OTRO"
            ),
            "estado_propuesta": F.when(h % 7 < 3, ""),
            "valor_propuesta": (h % 1000).cast("string"),
            "motivo_venta_nocerrada": F.when(h % 5 == 0, mark),
            "observaciones": mark,
            "fecha_ultima_accion": F.when(h % 6 != 0, "2001-07-15"),
        }
        return (
            keys.withColumn("_h", digest_number(key_digest(["client_id", "branch"], 7), 6))
            .select(
                "client_id",
                "branch",
                (F.col("client_id") * 100 + F.length("branch") + F.ascii("branch")).alias("row_no"),
                *[column.alias(name) for name, column in note.items()],
            )
        )
