"""Search, categories, scores and stored models, against brute force and planted labels."""

from __future__ import annotations


import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import model
from holdfast.operators.categories import (
    category_dictionary,
    code_name,
    dictionary_sizes,
    encode_categories,
)
from holdfast.operators.metrics import with_prediction
from holdfast.operators.model import SearchGrid
from holdfast.operators.roc import mid_ranks, roc_auc
from holdfast.spec import KEYS

NUMERIC = ("monetary_value", "frequency", "volume", "recency", "max_gap")
SMALL = SearchGrid(
    trees=(9, 18), depths=(4, 6), leaf_rows=(1, 2), draws=5, folds=2, rungs=2, least_rows=60
)


def labelled(spark, label):
    """Rows with the market's feature columns; ``label`` is SQL on them."""
    h = F.pmod(F.xxhash64("id"), F.lit(1000))
    return (
        spark.range(400)
        .select(
            F.col("id").alias("client_id"),
            F.concat(F.lit("P"), (F.col("id") % 7).cast("string")).alias("product"),
            F.when(F.col("id") % 11 > 0, F.concat(F.lit("B"), (h % 3).cast("string"))).alias("branch"),
            (h * 1.5).alias("monetary_value"),
            (F.lit(4) + h % 9).cast("long").alias("frequency"),
            (h / 7).alias("volume"),
            (F.lit(1) + h % 12).cast("long").alias("recency"),
            (h % 5).cast("long").alias("max_gap"),
        )
        .na.fill({"branch": "B9"})
        .withColumn("segment", F.when(F.col("client_id") % 5 > 0, F.lit("s")))
        .withColumn("target", F.expr(label).cast("int"))
    )


def encoder_of(rows):
    return model.fit_encoder(rows, ["branch", "product", "segment"], NUMERIC)


def brute_auc(pairs):
    won = 0.0
    ones, zeros = [s for s, t in pairs if t == 1], [s for s, t in pairs if t == 0]
    for a in ones:
        won += sum((a > b) + (a == b) / 2 for b in zeros)
    return won / (len(ones) * len(zeros))


def test_auc_with_ties_nulls_and_one_class(spark):
    rng = np.random.default_rng(3)
    for scores in (rng.random(300), rng.integers(0, 4, 300) / 4, np.full(50, 0.5)):
        pairs = [(float(s), int(t)) for s, t in zip(scores, rng.integers(0, 2, len(scores)))]
        more = [(None, 1), (float("nan"), 0), (0.3, None)]
        df = spark.createDataFrame(pairs + more, "score double, target int").repartition(5)
        row = roc_auc(df, "score").first()
        assert row.auc == pytest.approx(brute_auc(pairs), abs=1e-12)
        assert row.positives + row.negatives == len(pairs)
    alone = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, target int")
    assert tuple(roc_auc(alone, "score").first()) == (2, 0, None)
    assert tuple(roc_auc(alone.where("false"), "score").first()) == (0, 0, None)


def test_auc_of_more_pairs_than_a_long_holds(spark):
    from unittest import mock

    from holdfast.operators import roc

    many = 10**10  # rows of one score and class
    groups = spark.createDataFrame(
        [(0.1, many, 3 * many, 0, 0), (0.2, 2 * many, many, many, 3 * many)],
        "score double, positives long, negatives long, positives_below long, negatives_below long",
    )
    with mock.patch.object(roc, "score_groups", lambda *_: groups):
        auc = roc.roc_auc(groups, "score").first()["auc"]
    assert auc == pytest.approx((1 * 3 / 2 + 2 * (3 + 1 / 2)) / (3 * 4), abs=1e-15)


def test_mid_ranks(spark):
    values = [0.5, 0.1, 0.5, 0.9, 0.5, None, 0.1]
    df = spark.createDataFrame(list(enumerate(values)), "id int, x double")
    got = {r.id: r.mid_rank for r in mid_ranks(df, "x").collect()}
    assert got == {0: 4.0, 1: 1.5, 2: 4.0, 3: 6.0, 4: 4.0, 5: None, 6: 1.5}


def test_category_codes(spark):
    values = ["a"] * 5 + ["b"] * 3 + ["c"] * 3 + ["d"] * 2 + ["e", None]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x string, n int")
    dictionary = category_dictionary(df, ["x", "n"], least_rows=2, most_values=3)
    found = sorted((r["column"], r.code, r.value, r.n) for r in dictionary.collect())
    assert found == [("x", 0, "a", 5), ("x", 1, "b", 3), ("x", 2, "c", 3)]
    sizes = dictionary_sizes(dictionary, ["x", "n"])
    assert sizes == {"x": 3, "n": 0}
    unseen = df.union(spark.createDataFrame([("zz", 99)], df.schema))
    coded = encode_categories(unseen, dictionary, sizes)
    codes = {r.x: r[code_name("x")] for r in coded.collect()}
    assert codes == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 3, "zz": 3, None: 4}
    assert {r[0] for r in coded.select(code_name("n")).collect()} == {0.0}  # all are rare


def test_vectors_of_null_and_rare_values(spark):
    rows = labelled(spark, "frequency >= 8")
    encoder = encoder_of(rows)
    made = encoder.transform(rows.limit(20)).select("segment", "branch", "features").collect()
    length = 5 + sum(n + 1 for n in encoder.sizes.values())
    for r in made:
        vector = r.features.toArray()
        assert len(vector) == length
        assert vector[5:].sum() == 2 + (r.segment is not None)  # a null has zeros everywhere
    other = rows.limit(1).withColumn("branch", F.lit("never seen"))
    vector = encoder.transform(other).first()["features"].toArray()
    assert vector[5 + encoder.sizes["branch"]] == 1


def test_rungs():
    grid = SearchGrid()
    assert grid.survivors() == [20, 7, 3] and len(grid.sample()) == 20
    assert grid.shares(10**7) == [1 / 9, 1 / 3, 1.0]
    assert grid.shares(20_000) == [0.5, 0.5, 1.0] and grid.shares(50) == [1.0] * 3
    draw = dict(numTrees=1000, maxDepth=10)
    assert [grid.thinned(draw, k)["numTrees"] for k in range(3)] == [112, 334, 1000]


def test_samples_are_nested_and_repeatable(spark):
    rows = labelled(spark, "frequency >= 8")
    grid = SearchGrid(least_rows=10)
    one = {r.client_id: (r.fold, r.rung) for r in model.rung_samples(rows, grid).collect()}
    two = model.rung_samples(rows.repartition(7), grid).collect()
    assert one == {r.client_id: (r.fold, r.rung) for r in two}
    counts = [sum(rung <= k for _, rung in one.values()) for k in range(3)]
    assert 20 < counts[0] < 75 and 90 < counts[1] < 180 and counts[2] == 400


def test_search_finds_what_a_constant_model_cannot(spark):
    rows = labelled(spark, "frequency >= 8")
    fitted = model.calibrate(encoder_of(rows), rows, grid=SMALL)
    tried = fitted.search
    assert [sum(t["rung"] == k for t in tried) for k in range(2)] == [5, 2]
    last = max((t for t in tried if t["rung"] == 1), key=lambda t: t["accuracy"])
    assert {k: last[k] for k in fitted.best} == fitted.best
    assert all(t["trees"] == t["numTrees"] for t in tried if t["rung"] == 1)
    assert all(t["trees"] < t["numTrees"] for t in tried if t["rung"] == 0)
    report = {r["class"]: r for r in model.evaluate(fitted, rows).collect()}
    test = fitted.test.groupBy("target").count().collect()
    constant = max(r["count"] for r in test) / sum(r["count"] for r in test)
    assert report["accuracy"].precision > constant + 0.3
    assert report["Score AUC"].precision > 0.95
    # A model without any knowledge scores every row alike.
    blind = rows.withColumn("churn_probability", F.lit(0.7))
    assert roc_auc(blind, "churn_probability").first()["auc"] == 0.5


def test_draws_of_one_rung_are_all_fitted_whole():
    from holdfast.catalog.queries import GRID, WHOLE

    assert WHOLE.sample() == GRID.sample() and WHOLE.folds == GRID.folds
    assert WHOLE.survivors() == [20] and WHOLE.shares(10**7) == [1.0]
    assert all(WHOLE.thinned(d, 0) == d for d in WHOLE.sample())


def test_search_fits_all_training_rows_whatever_their_number(spark):
    """By default no draw is thinned out, and no setting bounds the rows that are fitted."""
    import inspect
    from dataclasses import replace

    default = inspect.signature(model.calibrate).parameters["grid"].default
    assert default.survivors() == [20] and default.shares(10**9) == [1.0]
    assert all(default.thinned(d, 0) == d for d in default.sample())
    grid = replace(SMALL, draws=2, rungs=1)
    object.__setattr__(grid, "most_rows", 100)  # rows beyond a bound, which there was once
    rows = labelled(spark, "frequency >= 8")
    churners = rows.where("frequency > 3 and target = 1").count()
    others = min(churners, rows.where("frequency > 3 and target = 0").count())
    fitted = model.calibrate(encoder_of(rows), rows, grid=grid)
    tested = fitted.test.count()
    assert 0 < tested < (churners + others) / 2
    assert {t["rows"] for t in fitted.search} == {churners + others - tested}


def test_rows_in_hash_order_do_not_hang_on_their_order_before(spark):
    from holdfast.operators.ranking import order_by_hash

    rows = labelled(spark, "frequency >= 8")

    def places(df):
        return [r.client_id for r in order_by_hash(df, KEYS, 42).collect()]

    found = places(rows)
    assert found == places(rows.orderBy(F.desc("client_id")).repartition(5))
    assert sorted(found) == list(range(400)) != found


def test_learning_query_fits_every_draw_on_all_rows():
    from holdfast.catalog.queries import FEW, GRID

    assert FEW.sample() == GRID.sample()[:6] and FEW.survivors() == [6]
    assert FEW.shares(10**7) == [1.0] and all(FEW.thinned(d, 0) == d for d in FEW.sample())


def test_forests_send_no_trees_with_tasks_and_wrap_none_unasked(spark):
    from unittest import mock

    from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassifier

    rows = labelled(spark, "frequency >= 8")
    coded = encoder_of(rows).transform(rows).coalesce(1)
    params = dict(numTrees=9, maxDepth=12, minInstancesPerNode=1, bootstrap=True)
    wrap = DecisionTreeClassificationModel.__init__
    with mock.patch.object(
        DecisionTreeClassificationModel, "__init__", autospec=True, side_effect=wrap
    ) as wrapped:
        forest = model._forest(42, params)
        fitted = forest.fit(coded)
        assert forest.getCacheNodeIds() and wrapped.call_count == 0
        assert len(fitted.trees) == wrapped.call_count == 9
    plain = RandomForestClassifier(
        labelCol="target", featuresCol="features", featureSubsetStrategy="sqrt", seed=42, **params
    ).fit(coded)
    assert fitted.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]


def test_fits_of_a_search_run_side_by_side(spark):
    """All folds at once, and the forests of a draw without rivals with them."""
    import threading
    from unittest import mock

    rows = labelled(spark, "frequency >= 8")
    alone = SearchGrid(
        trees=(5,), depths=(4,), leaf_rows=(1,), bootstrap=(True,), draws=1, folds=2, rungs=1
    )
    meet, plain = threading.Barrier(4, timeout=60), model._forest

    def forest(*args):
        made = plain(*args)
        fit = made.fit
        made.fit = lambda data: (meet.wait(), fit(data))[1]
        return made

    with mock.patch.object(model, "_forest", forest):
        fitted = model.calibrate(encoder_of(rows), rows, grid=alone)
    assert [t["draw"] for t in fitted.search] == [0] and 0 <= fitted.search[0]["accuracy"] <= 1
    assert fitted.held_out.getNumTrees == fitted.classifier.getNumTrees == 5


def test_stored_model_scores_as_before_and_refuses_other_features(spark, tmp_path):
    rows = labelled(spark, "frequency >= 8")
    path = str(tmp_path / "model")
    params = dict(numTrees=12, maxDepth=6, minInstancesPerNode=1, bootstrap=True)
    fitted = model.fit_forest(encoder_of(rows), rows, params)
    model.save_model(fitted, path)
    loaded = model.load_model(path)

    def scores(found):
        scored = with_prediction(model.score(found, rows))
        return {tuple(r[k] for k in KEYS): r.churn_probability for r in scored.collect()}

    assert scores(loaded) == scores(fitted)
    for changed in (
        rows.drop("volume"),
        rows.withColumn("frequency", F.col("frequency").cast("string")),
        rows.withColumnRenamed("segment", "part"),
    ):
        with pytest.raises(ValueError, match="differ"):
            model.score(loaded, changed)
    shorter = spark.read.parquet(f"{path}/dictionary").where("code > 0")
    other = str(tmp_path / "other")
    model.save_model(fitted, other)
    shorter.write.mode("overwrite").parquet(f"{other}/dictionary")
    with pytest.raises(ValueError, match="codes"):
        model.load_model(other)


def test_one_class_is_refused(spark):
    rows = labelled(spark, "true")
    with pytest.raises(ValueError, match="one class"):
        model.fit_forest(encoder_of(rows), rows, dict(numTrees=2, maxDepth=2))
