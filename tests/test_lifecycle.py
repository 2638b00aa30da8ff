"""Monthly sums, text windows, commits, quarantine and sketches."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import commit, sketches
from holdfast.operators.activity import monthly_activity, sales_total
from holdfast.operators.commit import Output
from holdfast.operators.increments import MonthlyParts
from holdfast.operators.quantiles import cap_floor, order_statistics
from holdfast.plans.lists import quarantined, reload_lists
from holdfast.plans.markets import MARKETS
from holdfast.plans.monthly import load_parts, market_parts, source_lines
from holdfast.operators.prepare import prepare_sales, scope_sales
from holdfast.session import list_folders
from holdfast.sources.feedback import NOTE_COLUMNS, read_feedback
from holdfast.sources.tables import month_marks, one_month, trailing_months
from tests.test_markets import AS_OF, MAKERS


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


# Text dates


def test_marks_tell_every_month_of_the_calendar():
    for start in (dt.date(2022, 6, 1), dt.date(1999, 1, 1), dt.date(2019, 12, 1), dt.date(2000, 1, 1)):
        marks = month_marks(start)
        for year in [*range(1000, 10000, 97), *range(1985, 2060)]:
            for month in range(1, 13):
                later = (year, month) >= (start.year, start.month)
                for text in (f"{month:02d}/{year}", f" 28/{month:02d}/{year} "):
                    assert any(m in text for m in marks) == later, (start, text)


@pytest.mark.parametrize("pattern, shape", [("dd/MM/yyyy", "%d/%m/%Y"), ("MM/yyyy", "%m/%Y")])
def test_text_window_reaches_the_source(spark, tmp_path, pattern, shape):
    rng = random.Random(4)
    days = [dt.date(2018, 1, 1) + dt.timedelta(days=rng.randrange(4000)) for _ in range(800)]
    rows = [(i, rng.choice(["", " "]) + d.strftime(shape) + rng.choice(["", "  "]), d) for i, d in enumerate(days)]
    path = str(tmp_path / "t")
    spark.createDataFrame([*rows, (-1, None, None)], "id int, t string, d date").write.parquet(path)
    df = spark.read.parquet(path)
    for after in (False, True):
        got = trailing_months(df, "t", dt.date(2024, 9, 15), 27, pattern, after)
        first = dt.date(2022, 6, 2 if after else 1)
        if pattern == "MM/yyyy":  # a month counts as its first day
            want = {i for i, _, d in rows if d.replace(day=1) >= first}
        else:
            want = {i for i, _, d in rows if d >= first}
        assert {r.id for r in got.collect()} == want
        plan = plan_of(got.select("id"))
        assert "StringContains(t,06/2022)" in plan and "StringContains(t,/2023)" in plan


def test_one_month_reaches_the_source(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(90).select(F.expr("date_add(DATE'2024-01-15', CAST(id AS INT))").alias("d"))
    days.write.parquet(path)
    got = one_month(spark.read.parquet(path), "d", dt.date(2024, 2, 9))
    assert got.agg(F.min("d"), F.max("d"), F.count("d")).first()[:] == (
        dt.date(2024, 2, 1), dt.date(2024, 2, 29), 29,
    )
    assert "GreaterThanOrEqual(d,2024-02-01), LessThan(d,2024-03-01)" in plan_of(got)


# Monthly sums


def sorted_rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def lines_frame(spark, seed=1):
    rng, rows = random.Random(seed), []
    for n in range(1500):
        day = dt.date(2021, 3, 1) + dt.timedelta(days=rng.randrange(1250))
        amount = rng.choice([None, rng.uniform(-1e6, 1e6), 1e-9 * rng.random(), 2e15 * rng.random()])
        rows.append(
            (
                rng.choice([None, 1, 2, 3]),
                rng.choice(["a", "b", None]),
                rng.choice(["n", "s", None]),
                rng.choice([day, day, day, None]),
                day.replace(day=1),
                amount,
                rng.choice([None, rng.random()]),
            )
        )
    schema = (
        "client_id long, product string, branch string, sale_date date, period date, "
        "amount double, volume double"
    )
    return spark.createDataFrame(rows, schema)


def test_months_merge_to_the_bit(spark, tmp_path):
    lines = lines_frame(spark)
    parts = MonthlyParts(spark, str(tmp_path / "p"))
    months = [dt.date(2024, m, 1) for m in (3, 4, 5)]
    whole = lines.where(F.col("period") < months[0])
    parts.load(whole, whole)
    for i, as_of in enumerate(months):
        if i:
            new = lines.where(F.col("period") == months[i - 1])
            for _ in range(2):  # a repeated load changes nothing
                parts.load(new, new)
        gone = parts.drop_before(as_of)
        assert len(gone) == (9 if i == 0 else 1)
        window = lines.where(
            (F.col("period") < as_of) & (F.col("period") >= F.add_months(F.lit(as_of), -27))
        )
        full = monthly_activity(window, {"monetary_value": "amount"})
        assert sorted_rows(parts.activity(as_of)) == sorted_rows(full)
        assert sorted_rows(parts.sales_total(as_of)) == sorted_rows(sales_total(window))
    assert len(list_folders(spark, str(tmp_path / "p" / "activity"))) == 27


@pytest.mark.parametrize("code", MAKERS)
def test_market_by_increments(spark, tmp_path, code):
    """A market's activity from its stored months equals that of a run over all lines."""
    spec, inputs = MARKETS[code], MAKERS[code](spark)
    raw = source_lines(spec, inputs.sales, AS_OF)
    parts = market_parts(spec, spark, str(tmp_path))
    load_parts(spec, inputs, parts, raw)
    scoped = scope_sales(prepare_sales(raw, spec, inputs.tables), spec, inputs.tables)
    ended = scoped.where(F.col("period") < F.lit(AS_OF).cast("date"))
    full = monthly_activity(ended, spec.measures)
    assert full.count() > 0
    assert sorted_rows(parts.activity(AS_OF)) == sorted_rows(full)


# Commits


def month_table(spark, period, name, n, country="ar"):
    return spark.range(n).select(
        "id", F.lit(name).alias("name"), F.lit(country).alias("country"), F.lit(period).alias("period")
    )


def state(spark, root, names, market=None):
    found = {}
    for name in names:
        df = commit.read_published(spark, root, name, market)
        found[name] = {} if df is None else {
            (r.country, r.period): r["count"]
            for r in df.groupBy("country", "period").count().collect()
        }
    return found


def test_readers_see_whole_months_only(spark, tmp_path):
    root, names = str(tmp_path / "results"), ("a", "b", "c_view", "d", "e")

    def outputs(period, n, country="ar", broken=None):
        made = {}
        for name in names:
            df = month_table(spark, period, name, n, country)
            if name == broken:
                df = df.withColumn("name", F.concat("name", F.raise_error(F.lit("lost")).cast("string")))
            made[name] = Output(df, not name.endswith("_view"), name == "e")
        return made

    assert state(spark, root, names) == dict.fromkeys(names, {})
    assert commit.publish(spark, root, "ar", outputs("202407", 3)) == 1
    assert commit.publish(spark, root, "pe", outputs("202407", 4, "pe")) == 1
    july = {("ar", "202407"): 3, ("pe", "202407"): 4}
    assert state(spark, root, names) == dict.fromkeys(names, july)
    for broken in names:  # whichever table fails, nothing is seen of the new month
        with pytest.raises(Exception, match="lost"):
            commit.publish(spark, root, "ar", outputs("202408", 5, broken=broken))
        assert state(spark, root, names) == dict.fromkeys(names, july)
    assert commit.publish(spark, root, "ar", outputs("202408", 5)) == 2
    both = {**july, ("ar", "202408"): 5}
    newest = {("pe", "202407"): 4, ("ar", "202408"): 5}
    assert state(spark, root, names) == {**dict.fromkeys(names, both), "e": newest}
    # A rerun replaces its month; a table that has no row any more loses the month.
    again = outputs("202408", 6)
    again["d"] = Output(again["d"].rows.where("false"))
    assert commit.publish(spark, root, "ar", again) == 3
    both[("ar", "202408")] = 6
    newest[("ar", "202408")] = 6
    want = {**dict.fromkeys(names, both), "d": july, "e": newest}
    assert state(spark, root, names) == want
    old = commit.read_published(spark, root, "a", "ar", version=2)
    assert old.where("period = '202408'").count() == 5
    # Failed and replaced runs go, what is named stays.
    assert commit.vacuum(spark, root, "ar", keep=1) > 5
    assert state(spark, root, names) == want
    assert commit.versions(spark, root, "ar") == [3] and commit.versions(spark, root, "pe") == [1]
    assert set(state(spark, root, ["c_view"], "pe")["c_view"]) == {("pe", "202407")}


def test_second_of_two_commits_fails(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "results")
    rows = {"a": Output(month_table(spark, "202407", "a", 2))}
    commit.publish(spark, root, "ar", rows)
    known = commit.versions(spark, root, "ar")
    commit.publish(spark, root, "ar", rows)
    monkeypatch.setattr(commit, "versions", lambda *_: known)  # what a run at the same time saw
    with pytest.raises(Exception, match="(?i)exists"):
        commit.publish(spark, root, "ar", rows)


# Quarantine


def write_list(folder, names, rows, file="list.csv", start=""):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [",".join(names), *[",".join(r) for r in rows]]
    (folder / file).write_text(start + "\n".join(lines) + "\n")


def test_a_country_keeps_its_faults_to_itself(spark, tmp_path):
    names = ["client_id", "row_no", *NOTE_COLUMNS]
    drop, target = tmp_path / "a drop", str(tmp_path / "last")
    row = lambda i: [str(i), "1", *["x"] * len(NOTE_COLUMNS)]
    for country in ("ar", "bo", "cl", "pe", "py", "uy"):
        write_list(tmp_path / "first" / f"country={country}", names, [row(1), row(2)])
    assert reload_lists(spark, str(tmp_path / "first"), target).count() == 0
    assert quarantined(spark, target).count() == 0
    write_list(drop / "country=ar", names, [row(11), ["no", *row(1)[1:]]])
    write_list(drop / "country=bo", names[:-1], [row(12)[:-1]])
    write_list(drop / "country=cl", [*names, "client_id"], [[*row(13), "5"]])
    write_list(drop / "country=pe", [*reversed(names), "more"], [[*reversed(row(14)), "m"]], start="﻿")
    write_list(drop / "country=py", names, [row(15)])
    write_list(drop / "country=py", ["a", "b"], [["1", "2"]], "other list.csv")
    (drop / "country=uy").mkdir()
    (drop / "country=uy" / "list.csv").write_text("")
    rejected = reload_lists(spark, str(drop), target).collect()
    assert [(r.country, r.client_id) for r in rejected] == [("ar", None)]
    found = spark.read.parquet(target).groupBy("country").agg(F.sort_array(F.collect_list("client_id")).alias("c"))
    kept = {r.country: r.c for r in found.collect()}
    assert kept == {"ar": [11], "bo": [1, 2], "cl": [1, 2], "pe": [14], "py": [1, 2], "uy": [1, 2]}
    reasons = {(r.country, r.file.rsplit("/", 1)[1]): r.reason for r in quarantined(spark, target).collect()}
    assert reasons == {
        ("bo", "list.csv"): f"lacks {NOTE_COLUMNS[-1]}",
        ("cl", "list.csv"): "repeats client_id",
        ("py", "list.csv"): "another file of the country is held back",
        ("py", "other list.csv"): "lacks " + ", ".join(names),
        ("uy", "list.csv"): "holds no line",
    }


def test_nothing_but_faulty_files(spark, tmp_path):
    write_list(tmp_path / "d" / "country=ar", ["x"], [["1"]])
    found = read_feedback(spark, str(tmp_path / "d"))
    assert found.rows.count() == 0 and found.quarantine.count() == 1


# Sketches


def test_merged_sketches_stay_within_their_error(spark):
    rng = np.random.default_rng(9)
    values = np.concatenate([rng.normal(0, 1, 30_000), np.full(20_000, 0.25), rng.exponential(9, 10_000)])
    rng.shuffle(values)
    df = spark.createDataFrame(
        [(float(v), i // 3 % 24, "ab"[i % 3 == 0]) for i, v in enumerate(values)],
        "x double, month int, g string",
    ).union(spark.createDataFrame([(None, 1, "a"), (float("nan"), 2, "b")], "x double, month int, g string"))
    monthly = sketches.quantile_sketches(df, ["x"], ["g", "month"])
    assert monthly.count() == 48
    merged = sketches.merge_sketches(monthly, ["g"])
    assert 0.0014 < sketches.rank_error() < 0.0015
    probs = [0.001, 0.1, 0.5, 0.9, 0.999]
    for r in sketches.sketch_quantiles(merged, probs).collect():
        own = np.sort([v for i, v in enumerate(values) if "ab"[i % 3 == 0] == r.g])
        assert r.n == len(own) and r.value in own
        low, high = np.searchsorted(own, r.value), np.searchsorted(own, r.value, "right")
        slack = 2 * sketches.rank_error() * len(own) + 1
        assert low - slack <= r.prob * len(own) <= high + slack
    limited = cap_floor(df, ["x"], 0.9, 0.1, "g", sketches=merged)
    exact = order_statistics(df.where("NOT isnan(x)"), ["x"], [0.9, 0.1], "g")
    for g, low, high in limited.where("NOT isnan(x)").groupBy("g").agg(F.min("x"), F.max("x")).collect():
        assert low == pytest.approx(exact[g, "x", 0.1][0], abs=0.1)
        assert high == pytest.approx(exact[g, "x", 0.9][0], abs=0.5)
