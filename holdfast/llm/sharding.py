"""Shards by extendible hashing, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.batches import column
from holdfast.llm.rows import documents, numbered, row_digest
from holdfast.session import store

SHARD_BYTES = 1 << 20
BITS = 60  # of the hash; more than any directory needs
FINER = 3  # bits the first directory has beyond one bucket per filled shard
LEVELS = 5  # depths that are added up at a time
STEP = 8  # bits that oversized buckets of the directory get in each further round


def hash_bits(digest: Column) -> Column:
    """The first ``BITS`` bits of a hex digest as a whole number."""
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def prefix(bits: Column, depth: int) -> Column:
    return F.shiftright(bits, BITS - depth)


def _levels(fine: DataFrame, top: int, depth: int) -> DataFrame:
    """Bytes and rows by prefix of each depth from ``top`` to ``depth``.

    A few depths at a time are added up from the highest that is known, so each prefix is
    read about ``LEVELS`` times however many depths there are.
    """
    known, high, all_ = depth, depth, None
    while True:
        low = max(top, known - LEVELS)
        levels = fine.select(
            F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"), "prefix", "bytes", "rows"
        ).withColumn("prefix", F.expr(f"shiftright(prefix, {known} - depth)"))
        levels = levels.groupBy("depth", "prefix").agg(
            F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
        )
        levels = store(levels, "levels")
        all_ = levels if all_ is None else all_.unionByName(levels)
        if low == top:
            return all_
        fine = levels.where(F.col("depth") == low).drop("depth")
        known, high = low, low - 1


def _leaves(
    fine: DataFrame, top: int, depth: int, limit: int
) -> tuple[DataFrame, DataFrame]:
    """From bytes and rows by prefix of ``depth`` bits, the directory: each of these prefixes
    with the shallowest depth (from ``top``) at which its bucket fits, and those that fit at
    none.

    A bucket fits within the byte limit, or if one row is all it holds.
    """
    levels = _levels(fine, top, depth)
    fits = (F.col("bytes") <= limit) | (F.col("rows") == 1)
    above = levels.where(fits).select(
        (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("_above")
    )
    first = (
        levels.where(fits)
        .withColumn("_above", F.shiftright("prefix", 1))
        .join(above, ["depth", "_above"], "left_anti")
    )
    wide = F.expr(f"shiftleft(1L, {depth} - depth)")
    directory = first.select(
        F.explode(
            F.sequence(F.col("prefix") * wide, (F.col("prefix") + 1) * wide - 1)
        ).alias("entry"),
        F.col("depth").alias("shard_depth"),
        F.col("prefix").alias("shard"),
        F.col("bytes").alias("shard_bytes"),
        F.col("rows").alias("shard_rows"),
    )
    oversized = levels.where((F.col("depth") == depth) & ~fits).select(
        F.col("prefix").alias("entry")
    )
    return directory, oversized


def shard(
    docs: DataFrame,
    *,
    text: str = "text",
    key: Sequence[str] = ("doc_id", "text"),
    carry: Sequence[str] = ("doc_id",),
    limit: int = SHARD_BYTES,
) -> DataFrame:
    """``carry``, ``n_bytes`` and the row's shard: ``shard_depth`` hash bits, ``shard`` (their
    value), ``shard_bytes`` and ``shard_rows``.

    The hash is of the key columns and of a number among rows that repeat them, so copies of
    a row spread like other rows.  A directory over hash prefixes names for each of its
    entries the bucket it belongs to; buckets within the limit have fewer bits than the
    directory and own several entries, and where a bucket exceeds the limit only its rows
    get further bits, until each shard fits.  A row larger than the limit is a shard of its
    own.  Null texts have 0 bytes; an empty table gives an empty one; carried columns keep
    their names and must not be named like results.
    """
    sized = docs.select(
        row_digest(*key).alias("_digest"),
        *map(column, carry),
        F.coalesce(F.octet_length(column(text)), F.lit(0)).cast("long").alias("n_bytes"),
    )
    named = numbered(store(sized, "sized"), "_digest", "_copy")
    named = named.withColumn("_bits", hash_bits(F.md5(F.concat("_digest", F.lit(":"), "_copy"))))
    rows = store(named.drop("_digest", "_copy"), "to-shard")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(BITS, max(1, -(-total // limit)).bit_length() + FINER)
    top, active, done = 0, rows, None
    while True:
        entry = prefix(F.col("_bits"), depth)
        fine = active.groupBy(entry.alias("prefix")).agg(
            F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")
        )
        directory, oversized = _leaves(fine, top, depth, limit)
        directory = store(directory, "directory")
        part = active.withColumn("entry", entry).join(directory, "entry").drop("entry")
        done = part if done is None else done.unionByName(part)
        oversized = store(oversized, "oversized")
        if oversized.isEmpty() or depth == BITS:
            break
        active = active.withColumn("entry", entry).join(oversized, "entry", "left_semi")
        active = store(active.drop("entry"), "to-shard")
        top, depth = depth + 1, min(BITS, depth + STEP)
    return done.select(
        *map(column, carry), "n_bytes", "shard_depth", "shard", "shard_bytes", "shard_rows"
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir))


ORACLE = f"""
WITH digests AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         md5(CASE WHEN doc_id IS NULL THEN 'n' ELSE 'v' || doc_id::VARCHAR END || '|' ||
             CASE WHEN text IS NULL THEN 'n' ELSE 'v' || text END || '|') AS digest
  FROM documents
), hashed AS (
  SELECT doc_id, n_bytes,
         ('0x' || substr(md5(digest || ':' || (row_number() OVER (PARTITION BY digest) - 1)::VARCHAR),
                         1, {BITS // 4}))::BIGINT AS bits,
         row_number() OVER () AS row_id
  FROM digests
), levels AS (
  SELECT row_id, doc_id, n_bytes, depth, bits >> ({BITS} - depth)::BIGINT AS shard
  FROM hashed, generate_series(0, {BITS}) AS d(depth)
), sums AS (
  SELECT depth, shard, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows
  FROM levels GROUP BY depth, shard
), first_fit AS (
  SELECT row_id, min(depth) AS depth
  FROM levels JOIN sums USING (depth, shard)
  WHERE shard_bytes <= {SHARD_BYTES} OR shard_rows = 1
  GROUP BY row_id
)
SELECT doc_id, n_bytes, depth::INTEGER AS shard_depth, shard, shard_bytes, shard_rows
FROM first_fit JOIN levels USING (row_id, depth) JOIN sums USING (depth, shard)
"""
