"""Mixing sources to target weights: blocks of words, drawn per output shard.

Everything here is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.batches import column
from holdfast.llm.rows import MOST_EQUAL, documents, numbered, row_digest, running_sums
from holdfast.llm.text import WORD_PATTERN
from holdfast.operators.ranking import global_row_number
from holdfast.session import store

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
BLOCK_WORDS = 64
SHARD_BLOCKS = 4096
SEED = 17
BUCKETS = 1024  # parts of a source's stream whose sizes are added up on their own
BINS = 65_536  # of equal probability, for drawing a block's source
ROUNDS = 16  # of the index permutation
_WORD_AND_SPACE = WORD_PATTERN + r"[\x20\x09-\x0D]*"


def sized_rows(docs: DataFrame, *, text: str, doc_id: str, source: str) -> DataFrame:
    """One stored row per document: ``digest`` and ``copy``, which name the row and tell
    repeated rows apart, ``doc_id``, ``source`` and ``size`` in words."""
    sized = docs.select(
        row_digest(doc_id, source, text).alias("digest"),
        column(doc_id).alias("doc_id"),
        column(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(column(text), F.lit(WORD_PATTERN)), F.lit(0))
        .cast("long")
        .alias("size"),
    )
    return store(numbered(store(sized, "unnumbered"), "digest", "copy"), "sized")


def source_targets(
    rows: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most_repeats: int = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per source, numbered by code point with null last: ``target`` words, and the
    ``slots`` (blocks drawn) that come nearest to it.

    A source stops at ``most_repeats`` times its size.  With sources in the order of that
    stop over weight, the level ``words per weight`` that is left for a source once all
    before it have stopped rises while they do and falls afterwards; its highest value is
    the level at which the excess has been shared again until none is above.

    Sources may be many (hosts, say): they are numbered and added up by sorted ranges, in
    whole numbers, sources of a weight being counted.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_row_number(sources, [F.col("source").asc_nulls_last()], "source_no")
    kind = (F.col("source_no") % len(weights)).cast("int")
    ready = ranked.withColumn("source_no", F.col("source_no") - 1).withColumn("kind", kind)
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), F.col("kind") + 1)
    stop = (most_repeats * F.col("source_size")).cast("double")
    ready = store(ready.withColumns({"weight": weight, "stop": stop}), "sources")
    of_kind = {f"kind_{k}": (F.col("kind") == k).cast("long") for k in range(len(weights))}
    whole_sums = [F.sum(c).alias(n) for n, c in of_kind.items()]
    all_ = ready.agg(F.sum("source_size").alias("size"), *whole_sums).first().asDict()
    before = running_sums(
        ready,
        [F.col("stop") / F.col("weight"), F.col("source_no")],
        {"size_before": F.col("source_size"), **of_kind},
    )
    left = share * (all_["size"] or 0) - most_repeats * F.col("size_before")
    weight_left = sum(
        ((all_[f"kind_{k}"] or 0) - F.col(f"kind_{k}")) * float(w) for k, w in enumerate(weights)
    )
    highest = F.lit(before.agg(F.max(left / weight_left)).first()[0]).cast("double")
    target = F.least("stop", highest * F.col("weight"))
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    whole = F.floor(F.try_divide("target", F.col("source_size"))).cast("long")
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    return (
        ready.withColumn("target", target)
        .withColumns({"blocks": blocks, "whole": F.coalesce(whole, F.lit(0))})
        .withColumn(
            "slots",
            F.col("whole") * F.col("blocks")
            + F.least("blocks", F.rint(rest / block_words).cast("long")),
        )
        .withColumn(
            "slots", F.least("slots", most_repeats * F.col("blocks"))
        )
        .select("source_no", "source", "weight", "source_size", "target", "blocks", "slots")
    )


def drawn_slots(
    spark: SparkSession,
    targets: DataFrame,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = SEED,
) -> DataFrame:
    """``shard``, ``source_no`` and ``ordinal``: for each source exactly its ``slots``.

    Each shard draws the source of each of its blocks, a multinomial draw by the share of
    slots.  A source's draws are numbered through the shards; those beyond its slots are
    handed, by rank, to the sources that were drawn too seldom.
    """
    total = targets.agg(F.sum("slots")).first()[0] or 0
    lower = F.col("lower")
    edge = lambda c: F.rint(c * (BINS / max(total, 1))).cast("long")
    by_number = targets.select("source_no", "slots")
    bins = running_sums(by_number, [F.col("source_no")], {"lower": F.col("slots")}).select(
        "source_no", edge(lower).alias("low"), edge(lower + F.col("slots")).alias("high")
    ).where("low < high")
    bins = bins.select("source_no", F.explode(F.sequence("low", F.col("high") - 1)).alias("bin"))
    parts = max(spark.sparkContext.defaultParallelism, -(-total // 4_000_000))
    draws = spark.range(0, total, 1, parts).select(
        F.expr(f"id div {shard_blocks}").alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(BINS)).alias("bin"),
    )
    # At most 65,536 bins, whatever the number of sources.
    counts = draws.join(F.broadcast(bins), "bin").groupBy("shard", "source_no").agg(
        F.count(F.lit(1)).alias("n")
    )
    counts = store(counts, "draws")
    drawn = counts.groupBy("source_no").agg(F.sum("n").alias("drawn"))
    state = targets.join(drawn, "source_no", "left").select(
        "source_no", "slots", F.coalesce("drawn", F.lit(0)).alias("drawn")
    )
    over = F.greatest(F.col("drawn") - F.col("slots"), F.lit(0))
    under = F.greatest(F.col("slots") - F.col("drawn"), F.lit(0))
    state = running_sums(
        state,
        [F.col("source_no")],
        {"over_before": over, "under_before": under, "drawn_before": F.col("drawn")},
    )
    state = store(state, "draw-state")
    # Draws of all sources one after the other, less those of the sources before.
    runs = running_sums(counts, [F.col("source_no"), F.col("shard")], {"from": F.col("n")})
    runs = runs.join(state, "source_no").withColumn("from", F.col("from") - F.col("drawn_before"))
    # A few rows that become many: spread before they do.
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // 500_000))
    runs = runs.repartition(tasks, "shard", "source_no")
    end = F.col("from") + F.col("n")
    inside = runs.withColumn("to", F.least(end, F.col("slots"))).where("from < to")
    inside = inside.select(
        "shard", "source_no", F.explode(F.sequence("from", F.col("to") - 1)).alias("ordinal")
    )
    first = F.greatest("from", "slots")
    beyond = runs.withColumns({"first": first, "end": end}).where("first < end")
    beyond = beyond.select(
        "shard",
        F.explode(
            F.sequence(
                F.col("over_before") + F.col("first") - F.col("slots"),
                F.col("over_before") + F.col("end") - F.col("slots") - 1,
            )
        ).alias("rank"),
    )
    missing = state.where("drawn < slots").select(
        "source_no",
        F.posexplode(F.sequence("drawn", F.col("slots") - 1)).alias("at", "ordinal"),
        "under_before",
    )
    missing = missing.select(
        "source_no", "ordinal", (F.col("under_before") + F.col("at")).alias("rank")
    )
    filled = beyond.join(missing, "rank").select("shard", "source_no", "ordinal")
    return inside.unionByName(filled)


def permuted(index: Column, count: Column, *keys: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0..count-1 for each combination of keys.

    Each round pairs every index with another one (a keyed difference, modulo the count) and
    swaps the pair or not by a hash of its larger member, so each round is a permutation.
    """

    def one(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(1), r, *keys), count) - x, count)
        swap = F.pmod(F.xxhash64(F.lit(2), r, F.greatest(x, partner), *keys), F.lit(2)) == 1
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index, one)


def block_pieces(rows: DataFrame, targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The parts of documents in each block of their source's stream.

    The stream's order is by a hash of the row.  Offsets are sums inside hashed buckets of a
    source plus sums of bucket totals, so that a source that holds most rows is no window of
    its own.
    """
    bucket = F.pmod(F.xxhash64("digest", "copy"), F.lit(BUCKETS)).alias("bucket")
    words = rows.where("size > 0").select(
        F.col("source").alias("_source"), bucket, "digest", "copy", "doc_id", "size"
    )
    earlier = Window.unboundedPreceding, -1
    totals = words.groupBy("_source", "bucket").agg(F.sum("size").alias("bucket_size"))
    starts = totals.withColumn(
        "bucket_start",
        F.coalesce(
            F.sum("bucket_size").over(
                Window.partitionBy("_source").orderBy("bucket").rowsBetween(*earlier)
            ),
            F.lit(0),
        ),
    )
    named = starts.join(
        targets.select("source_no", "source"), F.col("_source").eqNullSafe(F.col("source"))
    ).select("source_no", "source", "bucket", "bucket_start")
    named = store(named, "bucket-starts")
    inner = F.sum("size").over(
        Window.partitionBy("_source", "bucket").orderBy("digest", "copy").rowsBetween(*earlier)
    )
    placed = words.withColumn("inner", F.coalesce(inner, F.lit(0))).withColumnRenamed(
        "bucket", "_bucket"
    )
    placed = placed.join(
        named,
        F.col("_source").eqNullSafe(F.col("source")) & (F.col("_bucket") == F.col("bucket")),
    ).withColumn("at", F.col("bucket_start") + F.col("inner"))
    blocks = F.sequence(
        F.expr(f"`at` div {block_words}"), F.expr(f"(`at` + size - 1) div {block_words}")
    )
    cut = placed.select(
        "source_no", "digest", "copy", "doc_id", "at", "size", F.explode(blocks).alias("block")
    )
    low = F.greatest("at", F.col("block") * block_words)
    high = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block_words)
    return cut.select(
        "source_no",
        "block",
        "digest",
        "copy",
        "doc_id",
        (low - F.col("at")).alias("start"),
        (high - low).alias("words"),
    )


def mix(
    docs: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most_repeats: int = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix as three tables: sized rows, sources with their targets, and placed pieces
    (``shard``, ``epoch``, ``block``, the row they are part of, ``start`` and ``words``).

    A source's words form one stream, cut into blocks of ``block_words``; only the last one
    is shorter.  A source takes its blocks in the order of a permutation, all of them before
    any comes again, so no document is taken more than ``most_repeats`` times.  What is
    taken differs from the target by at most a block or so.  All draws are hashes of indexes
    and row digests: reruns agree, whatever the partitioning.

    Null texts, empty texts and texts without words have size 0 and are never taken; null is
    a source of its own, the last; rows without ``doc_id`` and repeated rows are documents
    like others; an empty table gives empty tables; other columns are not read.
    """
    rows = sized_rows(docs, text=text, doc_id=doc_id, source=source)
    targets = store(source_targets(rows, weights, share, most_repeats, block_words), "targets")
    slots = drawn_slots(docs.sparkSession, targets, shard_blocks, seed)
    counts = targets.select("source_no", "blocks")
    numbers = slots.join(counts, "source_no").withColumns(
        {"epoch": F.expr("ordinal div blocks"), "index": F.expr("ordinal % blocks")}
    )
    chosen = numbers.select(
        "shard",
        "source_no",
        "epoch",
        permuted(
            F.col("index"), F.col("blocks"), F.lit(seed), F.col("source_no"), F.col("epoch")
        ).alias("block"),
    )
    pieces = block_pieces(rows, targets, block_words)
    return rows, targets, chosen.join(pieces, ["source_no", "block"])


def taken_words(rows: DataFrame, targets: DataFrame, placed: DataFrame) -> DataFrame:
    """One row per document with its source's size and target and the words taken of it."""
    taken = placed.groupBy("digest", "copy").agg(F.sum("words").alias("taken"))
    joined = rows.join(taken, ["digest", "copy"], "left")
    sources = targets.select(F.col("source").alias("_source"), "source_size", "target")
    return joined.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents as far as the mix takes them, with all their columns.

    ``text`` holds the taken parts in the order of the document, once for each time round,
    the rounds parted by a line feed; ``n_chars`` counts the new text.  Documents that are
    not taken go; each other row stays one row.
    """
    rows, _, placed = mix(docs)
    parts = placed.groupBy("digest", "copy").agg(
        F.sort_array(F.collect_list(F.struct("epoch", "start", "words"))).alias("_parts")
    )
    named = docs.withColumn("_digest", row_digest("doc_id", "source", "text"))
    # Only rows that repeat need a number to find their parts, which takes one more exchange.
    repeated = store(rows.where("copy = 1").select(F.col("digest").alias("_digest")), "repeated")
    single = named.join(repeated, "_digest", "left_anti").join(
        parts.where("copy = 0").select(F.col("digest").alias("_digest"), "_parts"), "_digest"
    )
    counts = rows.where(F.col("copy") >= MOST_EQUAL).groupBy(F.col("digest").alias("_digest"))
    several = numbered(
        named.join(repeated, "_digest", "left_semi"),
        "_digest",
        "_copy",
        counts.agg((F.max("copy") + 1).alias("n")),
    )
    several = several.join(
        parts.select(F.col("digest").alias("_digest"), F.col("copy").alias("_copy"), "_parts"),
        ["_digest", "_copy"],
    )
    used = [*map(column, docs.columns), F.col("_parts")]
    joined = single.select(*used).unionByName(several.select(*used))
    epochs = F.array_sort(F.array_distinct(F.transform("_parts", lambda p: p["epoch"])))

    def written(words: Column, epoch: Column) -> Column:
        mine = F.filter("_parts", lambda p: p["epoch"] == epoch)
        # Word by word: a slice would copy the whole array each time.
        at = F.flatten(
            F.transform(mine, lambda p: F.sequence(p["start"], p["start"] + p["words"] - 1))
        )
        return F.array_join(F.transform(at, lambda i: words[i.cast("int")]), "")

    # The words are the argument of a function, or they would be split anew for each part.
    split = F.regexp_extract_all("text", F.lit(_WORD_AND_SPACE), F.lit(0))
    texts = F.transform(
        F.array(split),
        lambda words: F.array_join(F.transform(epochs, lambda e: written(words, e)), "\n"),
    )
    out = joined.withColumn("_text", texts[0])
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("_text").alias("text"))
        elif name == "n_chars":
            kind = docs.schema["n_chars"].dataType
            columns.append(F.length("_text").cast(kind).alias("n_chars"))
        else:
            columns.append(column(name))
    return out.select(*columns)


def op7_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(*mix(documents(spark, sf_dir)))
