"""Hand-made rows for the rules that are easy to get wrong."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from holdfast.functions import predicates as pred
from holdfast.functions import values as val
from holdfast.operators import activity as act
from holdfast.operators import assign, features, joins, margins, metrics, prepare, rollup
from holdfast.operators import sampling, targeting
from holdfast.operators.risk import at_risk, buy_probability, classify_risk
from holdfast.sources.feedback import NOTE_COLUMNS
from holdfast.sources.tables import TableRef, read_table, trailing_months
from holdfast.spec import CodeOverride, Lookup, Rule, RiskLabels, Windows

L = RiskLabels()


def month(y, m):
    return dt.date(y, m, 1)


def one(df, column):
    return [r[column] for r in df.collect()]


LINES = (
    "client_id long, product string, branch string, period date, sale_date date, "
    "amount double, volume double"
)


def line(client, product, branch, date, amount=1.0, volume=1.0):
    period = date.replace(day=1) if date else month(2024, 1)
    return (client, product, branch, period, date, amount, volume)


def test_negative_tests_keep_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert one(df.where(pred.not_in_keep_null(F.col("x"), ["a"])), "x") == ["b", None]
    assert one(df.where(pred.differs_keep_null(F.col("x"), "a")), "x") == ["b", None]
    assert one(df.where(pred.in_list_or_null(F.col("x"), ["a"])), "x") == ["a", None]
    assert one(pred.apply_rules(df, [Rule("x", "not_in", ("a",)), Rule("x", "not_null")]), "x") == ["b"]
    assert pred.apply_rules(df, []).count() == 3


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (None,)], "x double")
    assert one(df.select(val.to_whole(F.col("x")).alias("y")), "y") == [0, 2, 2, 0, None]


def test_exact_sum(spark):
    def total(values, partitions=3):
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(partitions)
        return df.agg(val.exact_sum(F.col("x")).alias("t")).first()[0]

    small = spark.range(100_000).select(F.lit(0.00004).alias("x"))
    assert small.agg(val.exact_sum(F.col("x"))).first()[0] == pytest.approx(4.0, rel=1e-14)
    mixed = [1e15, 0.1, 0.2, -1e15, None, float("nan"), -3.00005, 1e-9, -2e-9]
    assert total(mixed) == pytest.approx(math.fsum(v for v in mixed if v and v == v), abs=1e-15)
    assert len({total(mixed * 40, n) for n in (1, 3, 7)}) == 1
    assert total([-0.25, -1.5]) == -1.75 and total([-1e-12] * 7) == pytest.approx(-7e-12, rel=1e-3)
    assert total([1e15] * 9) == 9e15 and total([1e300, 1.0]) == 1e300
    assert total([float("inf"), 1.0]) == float("inf")
    assert total([1e22, 1.0, -1e22]) == 1.0
    assert total([]) == 0.0 and total([None]) == 0.0


def test_null_keys_and_null_amounts(spark):
    day = dt.date(2024, 1, 5)
    df = spark.createDataFrame(
        [
            line(1, "A", "N", day, None, None),
            line(1, None, "N", day),
            line(None, "A", "N", day),
            line(2, "A", "N", None, 4.0),
        ],
        LINES,
    )
    rows = {r["client_id"]: r for r in act.monthly_activity(df, {"monetary_value": "amount"}).collect()}
    assert set(rows) == {1, 2}
    assert rows[1]["monetary_value"] == 0.0 and rows[1]["frequency"] == 1
    assert rows[2]["monetary_value"] == 4.0 and rows[2]["frequency"] == 0


def activity(spark, rows):
    return act.monthly_activity(spark.createDataFrame(rows, LINES), {"monetary_value": "amount"})


def test_gap_crosses_branches(spark):
    rows = [
        line(1, "A", "N", dt.date(2024, 1, 3)),
        line(1, "A", "S", dt.date(2024, 1, 9)),
        line(1, "A", "S", dt.date(2024, 4, 2)),
    ]
    found = act.with_gaps(activity(spark, rows)).orderBy("period", "branch")
    assert one(found, "max_gap") == [0, 0, 3]
    apart = act.with_gaps(
        activity(spark, [*rows, line(1, "A", "N", dt.date(2024, 3, 1))]), by_branch=True
    )
    assert one(apart.orderBy("branch", "period"), "max_gap") == [0, 2, 0, 3]


def test_reference_windows(spark):
    end = F.lit(month(2024, 8))
    cases = {24: "older", 12: "older", 11: "recent", 0: "recent", 25: None}
    for n, kind in cases.items():
        y, m = divmod(2024 * 12 + 7 - n, 12)
        found = act.past_reference(activity(spark, [line(1, "A", "N", month(y, m + 1))]), end)
        row = found.first()
        assert row["ref_period"] == (month(y, m + 1) if kind else None)
        assert row["ref_kind"] == ("older" if kind == "older" else "recent")
    both = [month(2023, 8), month(2022, 9), month(2024, 2), month(2024, 1)]
    row = act.past_reference(activity(spark, [line(1, "A", "N", p) for p in both]), end).first()
    assert row["ref_period"] == month(2023, 8)  # newest of the older window wins


def test_features_by_hand(spark):
    end = F.lit(month(2024, 8))
    rows = [
        line(1, "A", "N", dt.date(2023, 9, 5), 10.0, 1.0),
        line(1, "A", "N", dt.date(2023, 12, 5), 20.0, 2.0),
        line(1, "A", "N", dt.date(2024, 6, 5), 30.0, 3.0),
        line(2, "A", "N", dt.date(2023, 8, 5)),  # window is (2023-08, 2024-08]
        line(3, "A", "N", dt.date(2023, 7, 5), 5.0),
        line(3, "A", "N", dt.date(2024, 8, 5), 7.0),
    ]
    found = {r["client_id"]: r for r in features.build_features(activity(spark, rows), end).collect()}
    assert set(found) == {1, 3}
    first, third = found[1], found[3]
    assert first["monetary_value"] == 20.0 and first["volume"] == 2.0 and first["frequency"] == 3
    assert first["max_gap"] == 6 and first["last_purchase"] == month(2024, 6)
    # 2023-09-01 to 2024-06-01 is 274 days: 9.002 months, plus 1.
    assert first["recency"] == 10
    assert first["ref_kind"] == "recent" and first["mean_gap"] == pytest.approx(10 / 3)
    # 2023-07 is in the older window: (13 months + 1) / (1 purchase + 1).
    assert third["ref_kind"] == "older" and third["mean_gap"] == 7.0
    assert third["monetary_value"] == 7.0 and third["max_gap"] == 13


def test_label_edges(spark):
    end = F.lit(month(2024, 8))
    rows = [
        line(1, "A", "N", month(2024, 5)),
        line(2, "A", "N", month(2024, 6), -50.0),
        line(3, "A", "S", month(2024, 8)),
    ]
    labels = features.label_window(activity(spark, rows), end)
    assert {r["client_id"]: r["target"] for r in labels.collect()} == {2: 0, 3: 0}
    keys = spark.createDataFrame(
        [(1, "A", "N"), (2, "A", "N"), (3, "A", "N")], "client_id long, product string, branch string"
    )
    found = features.attach_label(keys, labels).collect()
    assert {r["client_id"]: r["target"] for r in found} == {1: 1, 2: 0, 3: 0}


def test_risk_thresholds(spark):
    now, before = month(2024, 8), month(2024, 5)
    rows = [
        (3, 0.9, before), (4, 0.8, before), (4, 0.7, before), (4, 0.5, before), (4, 0.49, before),
        (4, None, before), (3, 0.9, now), (4, 0.9, now),
    ]
    df = spark.createDataFrame(
        [(i, f, p, d, now) for i, (f, p, d) in enumerate(rows)],
        "id int, frequency int, churn_probability double, last_purchase date, analysis_period date",
    )
    found = buy_probability(classify_risk(df)).withColumn("risky", at_risk()).orderBy("id").collect()
    assert [r["risk_level"] for r in found] == [
        L.opportunity, L.lost, L.high, L.at_risk, L.stable, L.unknown, L.recent, L.recent,
    ]
    assert [r["churn_probability"] for r in found] == [None, 0.8, 0.7, 0.5, 0.49, None, None, 0.9]
    assert [r["buy_probability"] for r in found] == [0, 20, 30, 50, 51, 0, 0, 10]
    assert [bool(r["risky"]) for r in found] == [False, True, True, True, False, False, False, False]


def risk_frame(spark, rows):
    return spark.createDataFrame(
        rows,
        "client_id long, client_name string, product string, branch string, risk_level string, "
        "churn_probability double, total_value double, margin double, last_purchase date",
    )


def test_client_rollup(spark):
    p = month(2024, 5)
    risk = risk_frame(
        spark,
        [
            (1, "x", "A", "N", L.lost, 0.9, 100.0, 0.5, p),
            (1, "x", "B", "N", L.unknown, None, 300.0, None, p),
            (1, "x", "C", "N", L.opportunity, None, 50.0, 0.2, p),
            (2, "y", "A", "N", L.opportunity, None, 10.0, None, p),
            (3, "z", "A", "N", L.stable, 0.2, 0.0, 0.1, p),
        ],
    )
    rows = {r["client_id"]: r for r in rollup.client_rollup(risk).collect()}
    assert rows[1]["client_churn_probability"] == pytest.approx(0.225)
    assert rows[1]["client_margin_est"] == pytest.approx(0.125)
    assert rows[1]["potential_win"] == 10.0 and rows[1]["has_risk"]
    assert rows[2]["client_churn_probability"] is None and rows[2]["potential_win"] == 0.0
    assert rows[3]["client_churn_probability"] is None and rows[3]["potential_win"] is None
    assert not rows[3]["has_risk"]
    churn = {r["client_id"]: r for r in rollup.client_churn(risk).collect()}
    assert set(churn) == {1, 3} and churn[1]["client_margin_est"] == pytest.approx(0.125)
    shares = rollup.share_of_client(risk).groupBy("client_id").agg(F.sum("share").alias("s"))
    assert {r["client_id"]: r["s"] for r in shares.collect()} == {1: 1.0, 3: None}


def test_targets_are_callable(spark):
    """Each selected client has a callable row, so the selection needs no further test."""
    p = month(2024, 6)
    levels = [L.lost, L.recent, L.opportunity, L.stable, L.unknown]
    rows = [
        (i, f"n{i}", "A", "N", level, None if level == L.opportunity else prob, 5.0, 0.1, p)
        for i, (level, prob) in enumerate((lv, pr) for lv in levels for pr in (0.2, 0.9))
    ]
    risk = risk_frame(spark, rows)
    top = targeting.top_opportunities(risk, F.lit(month(2024, 8)))
    assert sorted(one(top, "client_id")) == [4, 5]
    seen = rollup.client_rollup(risk).withColumn("seller", F.lit(None).cast("string"))
    targets = targeting.select_targets(seen, top, ("VENDEDOR DEPOT",))
    can_call = at_risk() | (F.col("risk_level") == L.opportunity)
    gate = set(one(risk.where(can_call), "client_id"))
    ids = set(one(targets, "client_id"))
    assert ids and ids <= gate


def test_opportunity_months(spark):
    months = [month(2024, m) for m in (3, 4, 6, 7, 8)]
    rows = [(i, "n", "A", "N", L.opportunity, None, 5.0, 0.1, p) for i, p in enumerate(months)]
    top = targeting.top_opportunities(risk_frame(spark, rows), F.lit(month(2024, 8)))
    assert sorted(one(top, "client_id")) == [1, 2]  # four to two months before the newest


def test_latest_value_per_column(spark):
    df = spark.createDataFrame(
        [(1, "old", "x", month(2024, 1)), (1, None, "y", month(2024, 2)), (1, None, "z", month(2024, 2))],
        "client_id int, seller string, segment string, sale_date date",
    )
    row = joins.latest_values(df, ["client_id"], ["seller", "segment"], "sale_date").first()
    assert (row["seller"], row["segment"]) == ("old", "z")


def test_carry_over(spark):
    targets = spark.createDataFrame(
        [(1, "N"), (1, "S"), (2, "N"), (3, "N"), (4, "N")], "client_id long, branch string"
    )
    def old(client, row, status, reason):
        values = dict.fromkeys(NOTE_COLUMNS)
        values |= {"Estado": status, "motivo_contacto_fallido": reason}
        return (client, row, *values.values())

    last = spark.createDataFrame(
        [
            old(1, 1, "first", "why"),
            old(1, 2, "second", None),
            old(2, 1, None, "why"),
            old(3, 1, "x", L.not_at_risk_reason),
        ],
        "client_id long, row_no long, " + ", ".join(f"{c} string" for c in NOTE_COLUMNS),
    )
    rows = targeting.carry_over(targets, last).collect()
    assert len(rows) == 5
    by = {(r["client_id"], r["branch"]): r for r in rows}
    for branch in "NS":
        assert by[1, branch]["Estado"] == "second"
        assert by[1, branch]["motivo_contacto_fallido"] is None  # nulls are carried as well
    for client in (2, 3, 4):
        assert all(by[client, "N"][c] == "" for c in NOTE_COLUMNS)


def test_overrides_repairs_and_lookup(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "b", "k"), (3, None, "q")], "code int, product string, key string"
    )
    rules = (CodeOverride("product", "code", (1, 2), "X"), CodeOverride("product", "code", (2,), "Y"))
    assert one(prepare.apply_overrides(df, rules).orderBy("code"), "product") == ["X", "Y", None]
    repaired = df.orderBy("code").select(val.repair_text(F.col("product"), {"a": "A"}).alias("p"))
    assert one(repaired, "p") == ["A", "b", None]
    table = spark.createDataFrame([("k", "kv"), (None, "nv")], "kk string, v string")
    plain = joins.lookup(df, table, Lookup("t", (("key", "kk"),), {"product": "v"}))
    assert one(plain.orderBy("code"), "product") == [None, "kv", None]
    safe = joins.lookup(df, table, Lookup("t", (("key", "kk"),), {"product": "v"}), null_safe=True)
    assert one(safe.orderBy("code"), "product") == ["nv", "kv", None]


def test_margin_table(spark):
    df = spark.createDataFrame(
        [("A", 0.1, None, 0.3), ("B", None, None, 0.6)],
        "p string, N double, S double, `E 1` double",
    )
    found = margins.unpivot_margin(df, "p").collect()
    rows = {(r["product"], r["branch"]): r["margin"] for r in found}
    assert rows == {("A", "N"): 0.1, ("A", "E 1"): 0.3, ("B", "E 1"): 0.6}


def test_assignment_by_limit_and_list(spark):
    df = spark.createDataFrame(
        [(1, "v", 10.0), (2, "v", 5.0), (3, None, None)], "client_id long, seller string, sales_12m double"
    )
    assert one(assign.assign_by_limit(df, 5).orderBy("client_id"), "assignee") == ["v", L.centre, L.centre]
    ids = spark.createDataFrame([(2,), (2,)], "client_id long")
    assert one(assign.assign_by_list(df, ids).orderBy("client_id"), "assignee") == ["v", L.centre, None]


def test_shares_keep_every_row(spark):
    df = spark.createDataFrame(
        [(c, b, L.centre if c % 4 else "own") for c in range(41) for b in "NSE"],
        "client_id long, branch string, assignee string",
    )
    out = assign.allocate_shares(df, {"a": 0.3, "b": 0.7}).toPandas()
    assert len(out) == 123 and (out[out.client_id % 4 == 0].assignee == "own").all()
    drawn = out[out.client_id % 4 != 0].groupby("client_id").assignee.agg(["nunique", "first"])
    assert drawn["nunique"].max() == 1 and (drawn["first"] == "a").sum() == 9 and len(drawn) == 30
    part = assign.allocate_shares(df, {"a": 0.3}).toPandas()
    assert set(part.assignee) == {"own", "a", L.centre} and len(part) == 123


def test_share_bounds_are_sequential():
    assert assign.share_bounds(10, {"a": 0.25, "b": 0.25, "c": 0.5}) == [("a", 2), ("b", 5), ("c", 10)]


def test_sampling(spark):
    rows = [(i, "A", "N", 5 if i % 3 else 2, 1 if i < 20 else 0) for i in range(200)]
    df = spark.createDataFrame(
        rows, "client_id long, product string, branch string, frequency int, target int"
    )
    out = sampling.balance_classes(df)
    counts = {r["target"]: r["count"] for r in out.groupBy("target").count().collect()}
    assert counts == {1: 13, 0: 13} and out.where("frequency <= 3").count() == 0
    assert out.exceptAll(sampling.balance_classes(df.repartition(7))).count() == 0
    few = df.where("client_id < 25")
    assert sampling.balance_classes(few).where("target = 0").count() == few.where(
        "target = 0 and frequency > 3"
    ).count()
    parts = {r["part"]: r["count"] for r in sampling.split_by_hash(df).groupBy("part").count().collect()}
    assert sum(parts.values()) == 200 and 20 <= parts["test"] <= 60


def test_report_by_hand(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame([(t, p, 5) for t, p in pairs], "target int, prediction int, frequency int")
    rows = {r["class"]: r for r in metrics.metrics_table(df, df).collect()}
    assert rows["1"]["precision"] == pytest.approx(0.6) and rows["1"]["recall"] == 0.75
    assert rows["0"]["f1_score"] == pytest.approx(8 / 11) and rows["0"]["support"] == 6.0
    assert rows["accuracy"]["support"] == pytest.approx(0.7)
    assert rows["AUC"]["precision"] == pytest.approx((0.75 + 4 / 6) / 2)
    assert rows["Churn Rate"]["recall"] == pytest.approx(0.4)
    none = spark.createDataFrame([(0, 0)], "target int, prediction int")
    empty = {r["class"]: r for r in metrics.classification_report(none).collect()}
    assert empty["1"]["precision"] == 0.0 and metrics.auc_of_labels(none).first()["auc"] is None


def test_window_of_text_and_key_dates(spark):
    df = spark.createDataFrame(
        [(20220531, " 31/05/2022 "), (20220601, "01/06/2022")], "k int, t string"
    )
    as_of = dt.date(2024, 9, 15)
    assert one(trailing_months(df, "k", as_of, 27, "yyyyMMdd"), "k") == [20220601]
    assert one(trailing_months(df, "t", as_of, 27, "dd/MM/yyyy"), "k") == [20220601]
    assert one(trailing_months(df, "k", as_of, 27, "yyyyMMdd", after=True), "k") == []


def test_previous_month_over_new_year(spark):
    days = [dt.date(2023, 11, 30), dt.date(2023, 12, 1), dt.date(2023, 12, 31), dt.date(2024, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert one(df.where(pred.in_previous_month(F.col("d"), dt.date(2024, 1, 20))), "d") == days[1:3]


def test_empty_activity_has_no_features(spark):
    none = activity(spark, [line(1, "A", "N", month(2020, 1))]).where("false")
    assert features.build_features(none, F.lit(month(2024, 8)), Windows()).count() == 0


def test_catalog_table_reader(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert read_table(spark, TableRef("three", "table")).count() == 3
