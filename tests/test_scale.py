"""Whole-table ranks, quantiles and quotas against brute force, with one dominant key."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast.operators import activity as act
from holdfast.operators import assign
from holdfast.operators.quantiles import cap_floor, order_statistics
from holdfast.operators.ranking import global_row_number, rank_by_hash, top_per_group
from holdfast.spec import RiskLabels

CENTRE = RiskLabels().centre


def values(kind, rng):
    return {
        "spread": np.exp(rng.normal(3, 4, 5000)) * rng.choice([-1, 1], 5000),
        "one hot value": np.where(rng.random(5000) < 0.4, 7.25, rng.normal(0, 5, 5000)),
        "close": 1000 + rng.random(3000) / 100,
        "few": np.array([1.0, 2.0, 3.0, 10.0]),
        "single": np.array([-4.0]),
        "nulls": np.where(rng.random(500) < 0.3, np.nan, rng.normal(0, 1, 500)),
    }[kind]


@pytest.mark.parametrize("kind", ["spread", "one hot value", "close", "few", "single", "nulls"])
def test_quantiles_match_pandas(spark, kind):
    x = pd.Series(values(kind, np.random.default_rng(5)))
    df = spark.createDataFrame([(None if np.isnan(v) else float(v),) for v in x], "x double")
    probs = [0.0, 0.001, 0.25, 0.5, 0.8, 0.999, 1.0]
    found = order_statistics(df, ["x"], probs)
    for p in probs:
        low, high, fraction = found["", "x", p]
        assert low + (high - low) * fraction == pytest.approx(x.quantile(p), rel=1e-12, abs=1e-12)


def test_cap_then_floor_matches_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 3000), "x": np.exp(rng.normal(0, 3, 3000))})
    pdf["id"] = range(len(pdf))
    df = spark.createDataFrame(pdf)
    out = cap_floor(df, ["x"], 0.999, 0.3, "g").toPandas().set_index("id").x
    for _, part in pdf.groupby("g"):
        capped = np.minimum(part.x, part.x.quantile(0.999))
        want = np.maximum(capped, capped.quantile(0.3))
        assert np.allclose(out.loc[part.id], want, rtol=1e-12)
    tiny = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    got = sorted(r[0] for r in cap_floor(tiny, ["x"], 0.999, 0.001).where("x is not null").collect())
    assert got[-1] == pytest.approx(9.979) and got[0] == pytest.approx(1.003)
    assert cap_floor(tiny, ["x"], 0.999, 0.001).where("x is null").count() == 1
    assert cap_floor(tiny.where("false"), ["x"], 0.999, 0.001).count() == 0


def test_hash_rank_is_complete_and_repeatable(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    ranks = rank_by_hash(df.repartition(5), ["k"], 3).toPandas()
    assert sorted(ranks["rank"]) == list(range(1, 20001))
    again = rank_by_hash(df.repartition(3), ["k"], 3).toPandas()
    assert ranks.set_index("k")["rank"].sort_index().equals(again.set_index("k")["rank"].sort_index())
    first = rank_by_hash(df, ["k"], 3, first=777).toPandas()
    assert set(first.k) == set(ranks[ranks["rank"] <= 777].k)


def test_global_row_number(spark):
    rng = np.random.default_rng(2)
    # A third of the rows share one value; the key breaks ties.
    v = np.where(rng.random(9000) < 0.35, 1.0, rng.normal(0, 3, 9000))
    pdf = pd.DataFrame({"k": range(9000), "v": v})
    out = global_row_number(
        spark.createDataFrame(pdf).repartition(6), [F.col("v").desc(), F.col("k")]
    ).toPandas()
    want = pdf.sort_values(["v", "k"], ascending=[False, True]).k.tolist()
    assert out.sort_values("row_number").k.tolist() == want
    assert out.row_number.tolist() and sorted(out.row_number) == list(range(1, 9001))


def test_top_per_group_with_a_large_group(spark):
    rng = np.random.default_rng(4)
    g = np.where(rng.random(6000) < 0.4, 0, rng.integers(1, 30, 6000))
    pdf = pd.DataFrame({"g": g, "k": range(6000), "v": rng.integers(0, 50, 6000)})
    out = top_per_group(
        spark.createDataFrame(pdf), "g", [F.col("v").desc(), F.col("k")], 7, ["k"]
    ).toPandas()
    pdf = pdf.sort_values(["v", "k"], ascending=[False, True])
    want = pdf.groupby("g").head(7)
    assert set(out.k) == set(want.k)
    assert out.sort_values(["g", "rank"]).k.tolist() == want.sort_values(
        ["g", "v", "k"], ascending=[True, False, True]
    ).k.tolist()


def quota(pdf, quantile, smallest, largest, excluded):
    """The rules as a loop over sellers."""
    out = {}
    for seller, part in pdf.groupby("seller"):
        part = part.sort_values(["sales_12m", "client_id"], ascending=[False, True])
        if seller in excluded or len(part) < smallest:
            keep = 0
        elif len(part) <= largest:
            keep = len(part)
        else:
            reached = (part.sales_12m >= part.sales_12m.quantile(quantile)).sum()
            keep = min(max(reached, smallest), largest)
        for i, client in enumerate(part.client_id):
            out[client] = seller if i < keep else CENTRE
    return out


@pytest.mark.parametrize("quantile", [0.0, 0.2, 0.8, 0.97, 1.0])
@pytest.mark.parametrize("ties", [False, True])
def test_quota_matches_loop(spark, quantile, ties):
    rng = np.random.default_rng(8)
    sellers = rng.choice(
        ["huge", "big", "middle", "small", "out"], 900, p=[0.5, 0.3, 0.1, 0.005, 0.095]
    )
    sales = rng.integers(0, 6, 900) if ties else rng.integers(0, 10**6, 900)
    pdf = pd.DataFrame({"client_id": range(900), "seller": sellers, "sales_12m": sales * 1.0})
    pdf.loc[rng.random(900) < 0.1, "sales_12m"] = np.nan
    want = quota(pdf, quantile, 20, 100, ["out"])
    df = spark.createDataFrame(
        [
            (int(c), s, None if np.isnan(v) else float(v), "N")
            for c, s, v in pdf.itertuples(index=False)
        ],
        "client_id long, seller string, sales_12m double, branch string",
    )
    rows = assign.assign_quota(df, quantile, 20, 100, ("out",)).collect()
    assert len(rows) == 900
    assert {r["client_id"]: r["assignee"] for r in rows} == want


def test_quota_keeps_rows_without_seller(spark):
    df = spark.createDataFrame(
        [(1, None, 1.0, "N"), (2, "v", None, "N")],
        "client_id long, seller string, sales_12m double, branch string",
    )
    rows = {r["client_id"]: r["assignee"] for r in assign.assign_quota(df, 0.5, 1, 1).collect()}
    assert rows == {1: CENTRE, 2: "v"}


def test_gaps_with_a_dominant_client(spark):
    """One client holds most rows; result equals a lag over month and branch."""
    rng = np.random.default_rng(6)
    rows = {
        (1 if rng.random() < 0.6 else int(rng.integers(2, 40)), "A" if rng.random() < 0.7 else "B",
         f"b{rng.integers(0, 60)}", int(rng.integers(0, 27)))
        for _ in range(5000)
    }
    pdf = pd.DataFrame(sorted(rows), columns=["client_id", "product", "branch", "m"])
    pdf["period"] = [pd.Timestamp(2022, 1, 1) + pd.DateOffset(months=int(m)) for m in pdf.m]
    pdf = pdf.sort_values(["client_id", "m", "product", "branch"])
    before = pdf.groupby(["client_id", "product"]).m.shift().fillna(pdf.m)
    pdf["want"] = (pdf.m - before).astype(int)
    pdf["period"] = pdf.period.dt.date
    out = act.with_gaps(spark.createDataFrame(pdf)).toPandas()
    assert len(out) == len(pdf) and (out.want == out.max_gap).all()


def test_stored_tables_are_released(spark, tmp_path):
    import glob

    from holdfast.session import release_stored, scratch_root, shuffle_partitions, store

    kept = store(spark.range(10).toDF("x"), "probe")
    assert kept.where("x > 6").count() == 3
    assert glob.glob(f"{scratch_root(spark)}/holdfast-probe-*")
    assert release_stored(spark) >= 1
    assert not glob.glob(f"{scratch_root(spark)}/holdfast-probe-*")
    assert shuffle_partitions(10**14) == 372530 and shuffle_partitions(10) == 8


def test_hot_key_join_is_split(spark):
    """The planner cuts a dominant client's rows over tasks when they meet a client table."""
    from holdfast.operators.joins import drop_members, keep_members, lookup
    from holdfast.operators.targeting import target_detail
    from holdfast.operators.rollup import share_of_client
    from holdfast.spec import Lookup

    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long").alias("client_id"),
            F.col("id").cast("double").alias("total_value"),
            F.lit("Estable").alias("risk_level"),
        )
        table = spark.range(60000).select(F.col("id").alias("k"), F.lit("n").alias("name"))
        named = lookup(rows, table, Lookup("t", (("client_id", "k"),), {"name": "name"}))
        ids = table.select(F.col("k").alias("client_id"))
        kept, dropped = keep_members(rows, ids, "client_id"), drop_members(
            rows, ids.select((F.col("client_id") + 10**6).alias("client_id")), "client_id"
        )
        detail = target_detail(rows, ids)
        for df in (named, share_of_client(rows), kept, dropped, detail):
            assert len(df.collect()) == 60000
            assert "skewed" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
