"""The churn model: random-forest search, scoring, storage and hold-out evaluation."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.hashing import digest_number, key_digest, unit_interval
from holdfast.operators.categories import (
    category_dictionary,
    code_name,
    dictionary_sizes,
    encode_categories,
)
from holdfast.operators.metrics import metrics_table, with_prediction
from holdfast.operators.ranking import order_by_hash
from holdfast.operators.roc import roc_auc
from holdfast.operators.sampling import balance_classes, split_by_hash
from holdfast.session import store
from holdfast.spec import KEYS, NUMERIC_FEATURES, RiskRules


# The search space.  Spark grows trees to depth 30 at most and has no minimum
# split size, so depths above 30 and that parameter are left out.
@dataclass(frozen=True)
class SearchGrid:
    """Random draws from the space, thinned out rung by rung.

    The last rung fits whole forests on all rows; each rung before it has one ``thin``-th of
    the rows and of the trees of the next, and hands on the best ``thin``-th of its draws.
    """

    trees: Sequence[int] = (1000, 1200, 1400, 1600, 1800, 2000)
    depths: Sequence[int] = (10, 20, 30)
    leaf_rows: Sequence[int] = (1, 2, 4, 6)
    bootstrap: Sequence[bool] = (True, False)
    draws: int = 20
    folds: int = 4
    seed: int = 42
    parallelism: int = 4
    rungs: int = 3
    thin: int = 3
    least_rows: int = 10_000  # no rung's sample is smaller, if there are so many

    def sample(self) -> list[dict]:
        """Distinct random combinations."""
        space = [
            dict(numTrees=t, maxDepth=d, minInstancesPerNode=r, bootstrap=b)
            for t, d, r, b in itertools.product(
                self.trees, self.depths, self.leaf_rows, self.bootstrap
            )
        ]
        return random.Random(self.seed).sample(space, min(self.draws, len(space)))

    def survivors(self) -> list[int]:
        """How many draws each rung fits."""
        counts = [len(self.sample())]
        while len(counts) < self.rungs:
            counts.append(-(-counts[-1] // self.thin))
        return counts

    def shares(self, rows: int) -> list[float]:
        """Which share of ``rows`` each rung fits."""
        least = self.least_rows / rows if rows else 1.0
        return [
            min(1.0, max(self.thin ** (k + 1 - self.rungs), least)) for k in range(self.rungs)
        ]

    def thinned(self, draw: dict, rung: int) -> dict:
        """The draw with the trees it has on a rung."""
        trees = math.ceil(draw["numTrees"] / self.thin ** (self.rungs - 1 - rung))
        return dict(draw, numTrees=trees)


def rung_samples(rows: DataFrame, grid: SearchGrid, count: int | None = None) -> DataFrame:
    """Adds ``fold`` and ``rung``, the first rung whose sample holds the row.

    Samples are nested, as both come from the key's hash: what a rung has learned from stays
    in the next one, and a retried task draws the same rows.  ``count`` is the number of rows,
    counted here if not given.
    """
    shares = grid.shares(rows.count() if count is None else count)
    draw = unit_interval(KEYS, grid.seed + 1)
    rung: Column = F.lit(len(shares) - 1)
    for k in reversed(range(len(shares) - 1)):
        rung = F.when(draw < shares[k], k).otherwise(rung)
    fold = F.pmod(digest_number(key_digest(KEYS, grid.seed), 6), F.lit(grid.folds)).cast("int")
    return rows.withColumns({"fold": fold, "rung": rung.cast("int")})


@dataclass
class FeatureEncoder:
    """Categories to 0/1 vectors and everything to one feature vector.

    A null category has zeros everywhere, a rare or unseen one has a place that all such
    values share.
    """

    categories: Sequence[str]
    numeric: Sequence[str]
    dictionary: DataFrame
    sizes: dict[str, int]
    vectors: PipelineModel
    types: dict[str, str]

    def transform(self, rows: DataFrame) -> DataFrame:
        self.check(rows)
        coded = encode_categories(rows, self.dictionary, self.sizes)
        made = self.vectors.transform(coded)
        return made.select(*rows.columns, "features")

    def check(self, rows: DataFrame) -> None:
        """An error if a feature is missing or has another type than in the fit."""
        found = dict(rows.dtypes)
        wrong = {c: found.get(c, "missing") for c, t in self.types.items() if found.get(c) != t}
        if wrong:
            raise ValueError(f"features differ from those fitted: {wrong}, not {self.types}")


def fit_encoder(
    features: DataFrame, categories: Sequence[str], numeric: Sequence[str] = NUMERIC_FEATURES
) -> FeatureEncoder:
    """Fit on training and production rows together so both get the same columns.

    The category values stay in a table; what reaches the driver is their number per column.
    """
    dictionary = store(category_dictionary(features, categories), "dictionary")
    sizes = dictionary_sizes(dictionary, categories)
    codes, vectors = [code_name(c) for c in categories], [f"_{c}_vector" for c in categories]
    stages = [VectorAssembler(inputCols=[*numeric, *vectors], outputCol="features")]
    if categories:
        stages.insert(0, OneHotEncoder(inputCols=codes, outputCols=vectors, dropLast=True))
    coded = encode_categories(features, dictionary, sizes)
    found = dict(features.dtypes)
    return FeatureEncoder(
        tuple(categories),
        tuple(numeric),
        dictionary,
        sizes,
        Pipeline(stages=stages).fit(coded),
        {c: found[c] for c in (*numeric, *categories)},
    )


@dataclass
class ChurnModel:
    encoder: FeatureEncoder
    classifier: RandomForestClassificationModel
    best: dict = field(default_factory=dict)
    search: list[dict] = field(default_factory=list)
    held_out: object = None  # the best forest fitted without the test part
    test: DataFrame | None = None


class _Forest(RandomForestClassificationModel):
    """A fitted forest whose trees are wrapped for Python when they are asked for.  The class
    above wraps each of them, one call after the other, whenever a forest is made."""

    @property
    def trees(self) -> list:
        return RandomForestClassificationModel.trees.func(self)


class _ForestClassifier(RandomForestClassifier):
    def _create_model(self, java_model) -> _Forest:
        return _Forest(java_model)


def _forest(seed: int, params: dict | None = None) -> RandomForestClassifier:
    # With the node of every row kept on the executors, the tasks of a level need no trees:
    # without it the driver sends all trees grown so far with each of them.
    forest = _ForestClassifier(
        labelCol="target",
        featuresCol="features",
        featureSubsetStrategy="sqrt",
        seed=seed,
        cacheNodeIds=True,
    )
    return forest.setParams(**params) if params else forest


ROWS_A_TASK = 20_000  # rows that a task of a fit holds


def _training_rows(encoder: FeatureEncoder, rows: DataFrame, name: str = "training") -> DataFrame:
    """Encoded rows, stored because every fit reads them, in as many tasks as their number
    asks for: a forest grows in a job per level, and small tables need no more than one task."""
    target = F.col("target").cast("double").alias("target")
    kept = [c for c in ("fold", "rung") if c in rows.columns]
    stored = store(encoder.transform(rows).select(*KEYS, "features", target, *kept), name)
    return stored.coalesce(max(1, -(-stored.count() // ROWS_A_TASK)))


def check_two_classes(rows: DataFrame) -> None:
    found = {r[0] for r in rows.select("target").distinct().collect()}
    if len(found) < 2:
        raise ValueError("training rows hold one class only; both are needed")


def _side_by_side(jobs: Sequence[Callable], parallelism: int) -> list:
    """The jobs' results, in their order.  A fit of few rows has few tasks, so fits that do not
    need each other share the executors instead of waiting in turn."""
    start = inheritable_thread_target(SparkSession.active())
    with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
        return pool.map(lambda job: job(), [start(job) for job in jobs], chunksize=1)


def _fold_accuracy(rows: DataFrame, seed: int, params: dict, fold: int) -> float:
    """Accuracy on one fold of a forest fitted on the others."""
    fitted = _forest(seed, params).fit(rows.where(F.col("fold") != fold))
    judge = MulticlassClassificationEvaluator(labelCol="target", metricName="accuracy")
    return judge.evaluate(fitted.transform(rows.where(F.col("fold") == fold)))


def _search(
    rows: DataFrame, whole: DataFrame, grid: SearchGrid
) -> tuple[dict, list[dict], object, object]:
    """The best draw, every draw on every rung with its accuracy, and the best draw's forests on
    ``rows`` and on ``whole``.

    All folds of all draws of a rung are fitted side by side, and with them the forests of a
    draw that has no rival left.
    """
    left, tried, forests = list(enumerate(grid.sample())), [], []

    def forests_of(params):
        return [partial(_forest(grid.seed, params).fit, r) for r in (rows, whole)]

    for rung, keep in enumerate([*grid.survivors()[1:], 1]):
        sample = rows.where(F.col("rung") <= rung)
        sizes = {r["fold"]: r["count"] for r in sample.groupBy("fold").count().collect()}
        if missing := [k for k in range(grid.folds) if k not in sizes]:
            raise ValueError(f"folds {missing} of rung {rung} have no rows")
        jobs = [
            partial(_fold_accuracy, sample, grid.seed, grid.thinned(draw, rung), fold)
            for _, draw in left
            for fold in range(grid.folds)
        ]
        if len(left) == 1 and rung == grid.rungs - 1:
            *found, held_out, full = _side_by_side(
                [*jobs, *forests_of(left[0][1])], grid.parallelism
            )
            forests = [held_out, full]
        else:
            found = _side_by_side(jobs, grid.parallelism)
        scores = np.reshape(found, (len(left), grid.folds)).mean(axis=1).tolist()
        size = sum(sizes.values())
        tried += [
            dict(draw, draw=n, rung=rung, trees=grid.thinned(draw, rung)["numTrees"], rows=size,
                 accuracy=s)
            for (n, draw), s in zip(left, scores)
        ]
        order = sorted(range(len(left)), key=lambda i: (-scores[i], left[i][0]))
        left = [left[i] for i in sorted(order[:keep])]
    best = left[0][1]
    held_out, full = forests or _side_by_side(forests_of(best), grid.parallelism)
    return best, tried, held_out, full


def calibrate(
    encoder: FeatureEncoder,
    training: DataFrame,
    rules: RiskRules = RiskRules(),
    grid: SearchGrid = SearchGrid(rungs=1),
) -> ChurnModel:
    """Random search with cross-validated accuracy on the training part of balanced rows, then
    a fit of the best parameters on all of them.

    Every draw is fitted whole, on all rows of all folds but one at a time, however many there
    are; only a ``grid`` of several rungs thins draws out on nested samples.  The test part
    takes no part in the search.  Rows are put in the order of their key hash first, as a
    forest's draws go by a row's place.
    """
    balanced = balance_classes(training, rules.rare_until, rules.balance_seed)
    ordered = order_by_hash(balanced, KEYS, grid.seed)
    balanced = store(split_by_hash(ordered, rules.test_share, rules.split_seed), "balanced")
    train, test = (balanced.where(F.col("part") == p).drop("part") for p in ("train", "test"))
    rows = _training_rows(encoder, rung_samples(train, grid)).persist()
    check_two_classes(rows)
    whole = _training_rows(encoder, balanced, "balanced")
    best, tried, held_out, full = _search(rows, whole, grid)
    rows.unpersist()
    return ChurnModel(encoder, full, best, tried, held_out, test)


def fit_forest(
    encoder: FeatureEncoder, rows: DataFrame, params: dict, seed: int = 42
) -> ChurnModel:
    """A forest of known parameters on all rows given, without a search."""
    coded = _training_rows(encoder, rows)
    check_two_classes(coded)
    return ChurnModel(encoder, _forest(seed, params).fit(coded), params)


def score(model: ChurnModel, rows: DataFrame) -> DataFrame:
    """Adds ``churn_probability``, the probability of class 1."""
    scored = model.classifier.transform(model.encoder.transform(rows))
    return scored.select(
        *rows.columns, vector_to_array("probability")[1].alias("churn_probability")
    )


def save_model(model: ChurnModel, path: str) -> None:
    """Store the forest, the vector stages, the category dictionary and the features' names,
    roles and types under one folder, in place of what is there."""
    encoder, spark = model.encoder, model.encoder.dictionary.sparkSession
    PipelineModel([*encoder.vectors.stages, model.classifier]).write().overwrite().save(
        f"{path}/stages"
    )
    encoder.dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")
    roles = [(c, "numeric") for c in encoder.numeric] + [(c, "category") for c in encoder.categories]
    features = [
        (i, c, role, encoder.types[c], encoder.sizes.get(c)) for i, (c, role) in enumerate(roles)
    ]
    spark.createDataFrame(
        features, "place int, name string, role string, type string, size int"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/features")


def load_model(path: str) -> ChurnModel:
    """A stored model.  Its parts must fit each other: codes in the dictionary, their number in
    the feature list, and the length of the vector the forest was fitted on."""
    spark = SparkSession.active()
    listed = sorted(spark.read.parquet(f"{path}/features").collect())
    dictionary = spark.read.parquet(f"{path}/dictionary")
    *vectors, classifier = PipelineModel.load(f"{path}/stages").stages
    sizes = {r["name"]: r["size"] for r in listed if r["role"] == "category"}
    found = dictionary_sizes(dictionary, list(sizes))
    numeric = [r["name"] for r in listed if r["role"] == "numeric"]
    length = len(numeric) + sum(n + 1 for n in sizes.values())
    if found != sizes or length != classifier.numFeatures:
        raise ValueError(
            f"the stored parts differ: {found} codes for {sizes}, "
            f"vectors of {length} for a forest of {classifier.numFeatures}"
        )
    types = {r["name"]: r["type"] for r in listed}
    encoder = FeatureEncoder(
        list(sizes), numeric, dictionary, sizes, PipelineModel(list(vectors)), types
    )
    return ChurnModel(encoder, classifier)


def evaluate(
    model: ChurnModel, training: DataFrame, rules: RiskRules = RiskRules()
) -> DataFrame:
    """Metrics on the test part, of the best forest fitted on the training part, with the
    exact area under the curve of its probabilities."""
    scored = score(ChurnModel(model.encoder, model.held_out, model.best), model.test)
    scored = store(with_prediction(scored), "tested")
    report = metrics_table(scored, training, rules.rare_until)
    area = roc_auc(scored, "churn_probability").select(
        F.lit("Score AUC").alias("class"),
        *[F.col("auc").alias(c) for c in report.columns if c != "class"],
    )
    return report.unionByName(area)
