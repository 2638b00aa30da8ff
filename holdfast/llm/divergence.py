"""How the sources of a language differ in their words: Arrow counts, columnar shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from holdfast.llm.batches import column, limit_batches
from holdfast.llm.rows import documents
from holdfast.operators.joins import join_back
from holdfast.session import store

LEAST_DOCS = 30
ADDED = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
#: Fixed value: what lies between terms, which hold ASCII letters and all beyond ASCII.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Text that is split at one time, and counts that a task holds before it hands them on.
SLICE_BYTES = 8 << 20
HELD_ROWS = 1 << 18
#: Shares that a shard of terms holds at least and at most, sources times terms.
CELLS = 1 << 16, 1 << 24

COUNTS = T.StructType(
    [
        T.StructField("lang", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("term", T.StringType(), False),
        T.StructField("n", T.LongType(), False),
        T.StructField("docs", T.LongType(), False),
    ]
)
_KEYS = ["lang", "source", "term"]


def _slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.Table]:
    """The batch in parts of about ``size`` bytes of text; a longer text is a part alone."""
    sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
    cuts = np.cumsum(sizes, dtype=np.int64) // size
    starts = np.flatnonzero(np.diff(cuts, prepend=-1))
    for low, high in zip(starts, [*starts[1:], batch.num_rows]):
        yield pa.Table.from_batches([batch.slice(low, high - low)])


def _counted(part: pa.Table) -> pa.Table:
    """Occurrences and documents by language, source and term; a row with the empty term,
    which no text holds, for each language and source."""
    split = pc.split_pattern_regex(pc.ascii_lower(part["text"]), BETWEEN).combine_chunks()
    row = pc.list_parent_indices(split)
    terms = pc.list_flatten(split)
    real = pc.not_equal(terms, "")
    row, terms = pc.filter(row, real), pc.filter(terms, real)
    coded = pc.dictionary_encode(terms)
    pairs = pa.table({"row": row, "code": coded.indices})
    by_doc = pairs.group_by(["row", "code"]).aggregate([([], "count_all")])
    found = pa.table(
        {
            "lang": pc.take(part["lang"], by_doc["row"]),
            "source": pc.take(part["source"], by_doc["row"]),
            "term": pc.take(coded.dictionary, by_doc["code"].combine_chunks()),
            "n": by_doc["count_all"],
            "docs": pc.if_else(pc.is_valid(by_doc["count_all"]), 1, 0).cast(pa.int64()),
        }
    )
    empty = pa.table(
        {
            "lang": part["lang"],
            "source": part["source"],
            "term": pa.repeat(pa.scalar(""), part.num_rows),
            "n": pa.repeat(pa.scalar(0, pa.int64()), part.num_rows),
            "docs": pa.repeat(pa.scalar(0, pa.int64()), part.num_rows),
        }
    )
    return _summed(pa.concat_tables([found, empty]))


def _summed(table: pa.Table) -> pa.Table:
    made = table.group_by(_KEYS).aggregate([("n", "sum"), ("docs", "sum")])
    return made.select([*_KEYS, "n_sum", "docs_sum"]).rename_columns([*_KEYS, "n", "docs"])


def partial_counts(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    slice_bytes: int = SLICE_BYTES,
    held_rows: int = HELD_ROWS,
) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` occurrences and ``docs`` documents with the term, a
    row or a few from each task.

    Terms are stretches of ASCII letters and of all beyond ASCII, A-Z in lower case.  Null
    text, language and source are the empty string.  Each language and source that occurs
    has a row with the empty term and zeros, also without any term.  Repeated rows count
    as often as they occur; an empty table gives an empty one; other columns are not read.
    """
    limit_batches(docs)
    named = zip(("text", "lang", "source"), (text, lang, source))
    # Names of its own for each column, whatever a table calls them.
    plain = docs.select(
        *[F.coalesce(column(c).cast("string"), F.lit("")).alias(name) for name, c in named]
    )
    schema = to_arrow_schema(COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            for part in _slices(batch, slice_bytes) if batch.num_rows else ():
                held.append(_counted(part))
                rows += held[-1].num_rows
                if rows > held_rows:
                    held = [_summed(pa.concat_tables(held))]
                    rows = held[0].num_rows
                    if rows > held_rows // 2:
                        yield from held[0].cast(schema).to_batches(max_chunksize=1 << 14)
                        held, rows = [], 0
        if held:
            yield from _summed(pa.concat_tables(held)).cast(schema).to_batches(
                max_chunksize=1 << 14
            )

    return plain.mapInArrow(run, COUNTS)


def kept_counts(partial: DataFrame, least_docs: int) -> DataFrame:
    """The sums of ``partial_counts`` by language, source and term, of terms in ``least_docs``
    documents of the language or more, and of the empty term.

    Partial counts are dealt by language and term, so that one exchange serves the sums by
    source and the documents over all sources.  A term has a row per source and task at most,
    as the tasks have summed it, however many documents hold it.
    """
    dealt = partial.repartition("lang", "term").groupBy(*_KEYS)
    sums = dealt.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = F.sum("docs").over(Window.partitionBy("lang", "term"))
    wanted = (F.col("term") == "") | (F.col("lang_docs") >= least_docs)
    return sums.withColumn("lang_docs", whole).where(wanted).select(*_KEYS, "n")


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + ADDED) / (total + ADDED * terms))`` in whole numbers."""
    wide = "decimal(38,0)"
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + ADDED).cast("decimal(20,0)")
    below = (total + ADDED * terms).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", above.cast(wide), below).cast("long")


def divergences(
    docs: DataFrame,
    *,
    least_docs: int = LEAST_DOCS,
    top: int = TOP_TERMS,
    cells: tuple[int, int] = CELLS,
    **columns: str,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair``: every other source of the language, by the sum over all kept terms of the
    difference of shares.  Part ``term``: the ``top`` terms that the source holds and whose
    share there exceeds that in the language, by the difference.  Terms of ``least_docs`` or
    more documents of the language are kept; shares are smoothed and exact whole numbers, see
    ``share``.  Ranks start at 1, larger values first, then items in the order of UTF-8.  A
    source alone in its language has no pair; without kept terms all pairs are 0 apart.

    Counts are summed in the tasks that read the texts, and only sums move.  The shares of a
    language are dealt by term in shards; a shard adds up the differences of each pair of
    sources over its terms.  It holds eight numbers for each pair that it hands on, within the
    bounds ``cells``.
    """
    counts = store(kept_counts(partial_counts(docs, **columns), least_docs), "term-counts")
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    kept = store(kept, "kept-terms")
    # One row per language, and one per language and source.
    sources = counts.where("term = ''").groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    sizes = kept.groupBy("lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    langs = sources.join(sizes, "lang", "left").na.fill(0, ["total", "terms"])
    size = F.least(F.greatest(4 * F.col("sources") ** 2, F.lit(cells[0])), F.lit(cells[1]))
    shards = F.greatest(F.lit(1), F.ceil(F.col("sources") * F.col("terms") / size)).cast("int")
    langs = store(langs.select("*", shards.alias("shards")), "languages")
    # Each kept term's row has the language's own count, named by a null source.
    used = counts.join(kept.select("lang", "term", F.col("n").alias("lang_n")), ["lang", "term"])
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = counts.where("term = ''").select("lang", "source").join(
        totals, ["lang", "source"], "left"
    )
    groups = groups.join(langs.drop("sources"), "lang").select(
        "lang",
        "source",
        F.coalesce("n", F.lit(0)).cast("long").alias("source_total"),
        "total",
        "terms",
        "shards",
    )
    # The shares of a term that a source lacks; null without kept terms.
    blank = F.when(F.col("terms") > 0, share(F.lit(0), F.col("source_total"), F.col("terms")))
    groups = store(groups.withColumn("blank", blank), "sources")
    shares = join_back(used, groups, ["lang", "source"], "inner")
    shares = shares.select(
        "lang",
        "source",
        "term",
        share(F.col("n"), F.col("source_total"), F.col("terms")).alias("p"),
        share(F.col("lang_n"), F.col("total"), F.col("terms")).alias("q"),
        F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"),
    )
    shares = store(shares, "shares")
    pairs = _pairs(shares, groups, langs, kept)
    by_value = (F.desc("value"), F.asc("item"))
    ranked = pairs.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*by_value))
    ).withColumn("part", F.lit("pair"))
    typical = shares.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    # The best of each hashed part first, so that no source's terms meet in one task.
    slot = F.pmod(F.xxhash64("item"), F.lit(64))
    parted = Window.partitionBy("lang", "source", "slot").orderBy(*by_value)
    best = typical.withColumn("slot", slot).withColumn("place", F.row_number().over(parted))
    best = best.where(F.col("place") <= top)
    whole = Window.partitionBy("lang", "source").orderBy(*by_value)
    best = best.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
    out = ["lang", "source", "part", "item", "value", "rank"]
    return ranked.select(*out).unionByName(best.withColumn("part", F.lit("term")).select(*out))


_SUMS = T.StructType(
    [
        T.StructField("lang", T.StringType(), False),
        T.StructField("a", T.StringType(), False),
        T.StructField("b", T.StringType(), False),
        T.StructField("value", T.LongType(), False),
    ]
)


def _pairs(shares: DataFrame, groups: DataFrame, langs: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` and ``value``, both ways round."""
    shard = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    # To every shard each source's blank share, as a row without a term ...
    blanks = groups.select(
        "lang",
        shard.alias("shard"),
        "source",
        F.lit(None).cast("string").alias("term"),
        F.coalesce("blank", F.lit(0)).cast("long").alias("p"),
    )
    members = shares.select("lang", "shard", "source", "term", "p").unionByName(blanks)
    schema = to_arrow_schema(_SUMS)

    def differences(group: pa.Table) -> pa.Table:
        blank = group.filter(pc.is_null(group["term"])).sort_by("source")
        found = group.filter(pc.is_valid(group["term"]))
        names = blank["source"].combine_chunks()
        column_of = pc.dictionary_encode(found["term"].combine_chunks())
        base = blank["p"].to_numpy()
        matrix = np.repeat(base[:, None], len(column_of.dictionary), axis=1)
        row_of = pc.index_in(found["source"], names).to_numpy()
        matrix[row_of, column_of.indices.to_numpy()] = found["p"].to_numpy()
        size = len(names)
        value = [np.abs(matrix[i + 1 :] - matrix[i]).sum(axis=1) for i in range(size - 1)]
        left = np.repeat(np.arange(size), np.arange(size - 1, -1, -1))
        right = np.concatenate([np.arange(i + 1, size) for i in range(size)])
        lang = pa.repeat(group["lang"][0], len(left))
        value = np.concatenate([*value, np.zeros(0, np.int64)])
        arrays = [lang, names.take(pa.array(left)), names.take(pa.array(right)), pa.array(value)]
        return pa.Table.from_arrays(arrays, schema=schema)

    sums = members.groupBy("lang", "shard").applyInArrow(differences, _SUMS)
    sums = store(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "distances")
    back = sums.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    return sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
        back
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(documents(spark, sf_dir))


ORACLE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), uses AS (
    SELECT row, lang, source, unnest(w) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS n FROM uses GROUP BY lang, term HAVING count(DISTINCT row) >= 30
), lang_sizes AS (
    SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang
), grps AS (
    SELECT DISTINCT lang, source FROM docs
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM uses JOIN kept USING (lang, term)
    GROUP BY lang, source, term
), sizes AS (
    SELECT lang, source, coalesce(sum(n), 0) AS total
    FROM grps LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           CAST(1 + (1000000000 * CAST(coalesce(c.n, 0) + 5 AS HUGEINT)) // (s.total + 5 * l.v)
                AS BIGINT) AS p,
           CAST(1 + (1000000000 * CAST(k.n + 5 AS HUGEINT)) // (l.total + 5 * l.v) AS BIGINT) AS q
    FROM grps g JOIN kept k USING (lang) JOIN lang_sizes l USING (lang)
    JOIN sizes s USING (lang, source) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
), all_pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0) AS value
    FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), listed AS (
    SELECT lang, source, 'pair' AS part, item, value FROM all_pairs
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part
                                 ORDER BY value DESC, item COLLATE "binary") AS rank
    FROM listed
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
