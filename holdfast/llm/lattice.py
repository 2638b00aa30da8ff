"""Embedding near-duplicates by lattice hashing: cells of the E8 lattice in several tables."""

from __future__ import annotations

import functools
import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.batches import by_runs, column, expand
from holdfast.llm.groups import blocks_of, components, roots
from holdfast.llm.rows import row_digest
from holdfast.session import store

COSINE = 0.98
TABLES = 2
PROBES = 4  # neighbouring cells that a vector also enters, nearest first
SCALE = 1.0  # of the projections of unit vectors; larger makes cells finer
SEED = 8


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, the steps from a cell to its neighbours."""
    found = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            found.append(v)
    for signs in itertools.product((0.5, -0.5), repeat=8):
        if sum(s < 0 for s in signs) % 2 == 0:
            found.append(np.array(signs))
    return np.array(found)


STEPS = minimal_vectors()


def nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest whole-number points whose coordinates have an even sum (the lattice D8)."""
    point = np.rint(x)
    off = x - point
    rows = np.flatnonzero(point.sum(axis=1) % 2)
    worst = np.abs(off[rows]).argmax(axis=1)
    point[rows, worst] += np.where(off[rows, worst] >= 0, 1.0, -1.0)
    return point


def nearest_lattice_point(x: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 moved by one half in every coordinate; the nearer of the two."""
    whole, half = nearest_even(x), nearest_even(x - 0.5) + 0.5
    nearer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(nearer[:, None], half, whole)


class Cells:
    """Cell numbers of vectors of one dimension: ``tables`` x (own cell, then probes).

    A cell is a lattice point in each of ``blocks`` times 8 projected dimensions; a probe
    steps to a neighbour in one of them.  Vectors and projections are rounded to whole numbers
    whose products and sums doubles hold exactly, so a vector has the same cells in any batch.
    """

    def __init__(
        self, dimension: int, tables: int, probes: int, scale: float, seed: int, blocks: int = 1
    ):
        rng = np.random.default_rng([seed, dimension])
        normal = rng.normal(size=(tables, dimension, 8 * blocks)) * scale
        self.projections = np.rint(normal * 2.0**14)
        self.flat = self.projections.transpose(1, 0, 2).reshape(dimension, -1)
        self.factors = rng.integers(1, 1 << 62, size=(tables, 8 * blocks), dtype=np.int64) | 1
        self.tables, self.probes, self.blocks = tables, probes, blocks

    def of(self, unit: np.ndarray) -> np.ndarray:
        parts = [self._of(unit[at : at + 512]) for at in range(0, len(unit), 512)]
        return np.concatenate(parts) if parts else np.empty((0, *self.shape), np.int64)

    @property
    def shape(self) -> tuple[int, int]:
        return self.tables, 1 + self.probes

    def _of(self, unit: np.ndarray) -> np.ndarray:
        """All tables and blocks at once, as this is called for a few vectors at a time too."""
        doubled = np.rint(2 * STEPS).astype(np.int64)  # whole numbers, as points have halves
        factors = self.factors.reshape(self.tables, self.blocks, 8)
        x = np.rint(np.rint(unit * 2.0**28) @ self.flat * 2.0**-22) * 2.0**-20
        part = x.reshape(-1, 8)
        point = nearest_lattice_point(part)
        whole = np.rint(2 * point).astype(np.int64).reshape(-1, self.tables, self.blocks, 8)
        own = (whole * factors).sum(axis=(2, 3))[:, :, None]
        toward = ((part - point) @ STEPS.T).reshape(len(unit), self.tables, -1)
        order = np.argsort(-toward, axis=2, kind="stable")[:, :, : self.probes]
        steps = (factors @ doubled.T).reshape(self.tables, -1)
        probed = own + steps[np.arange(self.tables)[None, :, None], order]
        table = np.arange(self.tables)[None, :, None]
        return np.concatenate([own, probed], axis=2) * 64 + table


@dataclass(frozen=True)
class Setting:
    """Cells: more blocks of a smaller scale make more of them, so that fewer vectors meet in
    one; of pairs at the limit of 0.98 every setting lets at least 0.998 meet."""

    blocks: int
    tables: int
    probes: int
    scale: float


SETTINGS = (
    Setting(1, TABLES, PROBES, SCALE),
    Setting(2, 4, 4, 0.7),
    Setting(3, 4, 8, 0.5),
)
DEFAULT = SETTINGS[1]


def setting_for(count: int) -> Setting:
    """The same for every number of vectors: which pairs meet must not hang on how many other
    rows a table has."""
    return DEFAULT


MEMBERS = T.StructType(
    [
        T.StructField("cell", T.LongType(), False),
        T.StructField("label", T.LongType(), False),
        T.StructField("size", T.LongType(), False),
        T.StructField("class_id", T.LongType(), False),
        T.StructField("copies", T.LongType(), False),
        T.StructField("vector", T.BinaryType(), False),
    ]
)
FOUND = T.StructType(
    [
        T.StructField("class_id", T.LongType(), False),
        T.StructField("links", T.LongType(), False),
        T.StructField("root", T.LongType(), False),
    ]
)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no finite row over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1)[:, None]
    return scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]


def _makers(cells_as: Setting, seed: int):
    """The ``Cells`` of a dimension, made once in a task."""

    @functools.lru_cache(maxsize=None)
    def maker(dimension: int) -> Cells:
        return Cells(
            dimension, cells_as.tables, cells_as.probes, cells_as.scale, seed, cells_as.blocks
        )

    return maker


def _bytes_as(classes: DataFrame) -> str:
    """How vectors travel: as their own floats where these are of single precision."""
    return "<f4" if classes.schema["embedding"].dataType.elementType == T.FloatType() else "<f8"


def cell_members(classes: DataFrame, cells_as: Setting, seed: int):
    """A row of ``MEMBERS`` for every cell that a class of equal vectors enters."""
    kind = _bytes_as(classes)

    def start():
        maker_of = _makers(cells_as, seed)

        def compute(batch: pa.RecordBatch):
            label, ident, copies = (np.asarray(batch.column(i)) for i in (0, 1, 2))
            lists = batch.column(3)
            sizes = np.asarray(lists.value_lengths())
            flat = np.asarray(lists.flatten()).astype(np.float64)
            offsets = np.cumsum(sizes) - sizes
            out: list[list] = [[] for _ in MEMBERS]
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                vectors = flat[offsets[rows][:, None] + np.arange(size)]
                cells = maker_of(int(size)).of(unit_rows(vectors)).reshape(len(rows), -1)
                vector_bytes = [v.astype(kind).tobytes() for v in vectors]
                for n, row in enumerate(rows):
                    for cell in set(cells[n].tolist()):
                        values = (cell, label[row], size, ident[row], copies[row])
                        for store_, value in zip(out, (*values, vector_bytes[n])):
                            store_.append(value)
            return out

        return compute

    source = classes.select("label", "class_id", "copies", "embedding")
    return expand(source, MEMBERS, start)


def _linked(group: pa.Table, cosine: float, maker_of, kind: str):
    """Links inside one cell.  A pair meets in every cell that both vectors enter; it counts
    in the first of them alone, so sums over cells count each pair once.  For that the cells
    of linked vectors are found again, which costs less than carrying those of all."""
    size = group.column("size")[0].as_py()
    count = group.num_rows
    ident = np.asarray(group.column("class_id"))
    copies = np.asarray(group.column("copies"))
    own = np.asarray(group.column("own"))
    low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
    cell = group.column("cell")[0].as_py()
    vectors = np.frombuffer(b"".join(group.column("vector").to_pylist()), kind)
    unit = unit_rows(vectors.reshape(count, size).astype(np.float64))
    order = np.argsort(ident, kind="stable")
    ident, copies, own, unit = (x[order] for x in (ident, copies, own, unit))
    cells = None  # of the vectors that link, at their places
    known = np.zeros(count, bool)
    links = np.zeros(count, np.int64)
    label = np.arange(count)
    for at in range(0, count, 256):
        near = unit[at : at + 256] @ unit[at:].T >= cosine
        x, y = np.nonzero(near)
        forward = y > x
        x, y = x[forward] + at, y[forward] + at
        if low != high:
            across = own[x] != own[y]
            x, y = x[across], y[across]
        if not len(x):
            continue
        label = np.minimum(label, roots(count, np.r_[x, np.arange(count)], np.r_[y, label]))
        new = np.zeros(count, bool)
        new[x] = new[y] = True
        new = np.flatnonzero(new & ~known)
        if len(new):
            made = maker_of(size).of(unit[new])
            if cells is None:
                cells = np.zeros((count, *made.shape[1:]), np.int64)
            cells[new], known[new] = made, True
        for part in range(0, len(x), 20_000):
            i, j = x[part : part + 20_000], y[part : part + 20_000]
            same = (cells[i][:, :, :, None] == cells[j][:, :, None, :]).any(axis=3)
            flat = same.reshape(len(i), -1)
            keys = np.where(flat, cells[i].reshape(len(i), -1), np.iinfo(np.int64).max)
            here = keys.min(axis=1) == cell
            np.add.at(links, i[here], copies[j[here]])
            np.add.at(links, j[here], copies[i[here]])
    bound = np.flatnonzero((links > 0) | (label != np.arange(count)))
    return [ident[bound], links[bound], ident[label[bound]]]


def near_vectors(
    vectors: DataFrame,
    *,
    cosine: float = COSINE,
    cells_as: Setting | None = None,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors``
    (``vec_id``, ``label``, ``embedding``).

    Random projections take unit vectors to 8 dimensions, where the nearest E8 point is the
    cell, or to several times 8, where the points together are.  A vector enters that cell and
    the nearest neighbouring ones in each table, by ``DEFAULT`` for tables of any size if no
    setting is given; those that meet are compared exactly, in double precision, and link at ``cosine``
    or more if labels and dimensions are equal.  Equal vectors are one class: its copies
    link with each other and with all copies of linked classes, without being listed.

    Rows whose label or vector is null, zero or holds null or non-finite components have no
    links and are components of their own.  Repeated rows are vectors like others; a row
    without ``vec_id`` takes part but never names a component and is never kept, unless it
    has none but such links, when its component is null.  An empty table gives an empty one;
    other columns are not read.
    """
    cells_as = cells_as or DEFAULT
    base = vectors.select(
        column("vec_id").alias("vec_id"),
        column("label").cast("long").alias("label"),
        column("embedding").alias("embedding"),
    )
    finite = lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf"))
    valid = (
        F.col("label").isNotNull()
        & F.forall("embedding", finite)
        & F.exists("embedding", lambda v: v != 0)
    )
    named = base.withColumn(
        "digest", F.when(F.coalesce(valid, F.lit(False)), row_digest("label", "embedding"))
    )
    classes = (
        named.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min("vec_id").alias("first_id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
        )
        .withColumn("class_id", F.monotonically_increasing_id())
    )
    classes = store(classes, "vector-classes")
    members = blocks_of(cell_members(classes, cells_as, seed), "cell", "class_id")
    kind = _bytes_as(classes)
    keys = ["cell", "label", "size", "low", "high"]

    def start():
        maker_of = _makers(cells_as, seed)
        return lambda group: _linked(group, cosine, maker_of, kind)

    found = store(
        by_runs(members, keys, FOUND, start),
        "vector-links",
    )
    linked = components(found.where("class_id <> root").select("class_id", "root"), "vectors")
    counts = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    full = (
        classes.drop("embedding", "label")
        .join(counts, "class_id", "left")
        .join(linked, F.col("class_id") == F.col("node"), "left")
        .select(
            "digest",
            "first_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "class_id").alias("component"),
        )
    )
    full = store(full, "vector-full")
    smallest = full.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_digest = full.join(
        smallest.repartition("component", "component_id"), "component"
    ).select(F.col("digest").alias("_digest"), "n_links", "component_id")
    by_digest = store(by_digest, "vector-components")
    joined = named.select("vec_id", "digest").join(
        by_digest, F.col("digest") == F.col("_digest"), "left"
    )
    component_id = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(
        F.col("component_id")
    )
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component_id.alias("component_id"),
        F.coalesce(F.col("vec_id") == component_id, F.lit(False)).alias("kept"),
    )


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = f"""
WITH RECURSIVE valid AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), normed AS (
  SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM valid
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM normed a JOIN normed b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= {COSINE}
), reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), degree AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
), smallest AS (
  SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM smallest LEFT JOIN degree USING (vec_id)
"""
