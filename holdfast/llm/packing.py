"""Documents cut into token pieces and packed into sequences by the sum-of-squares rule."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.batches import annotate, column
from holdfast.llm.rows import documents
from holdfast.llm.tokens import word_coder
from holdfast.session import store

CAPACITY = 2048
SEPARATOR = 0
GROUP = 4096  # pieces that one task packs together, on average
SLACK = 32  # sequences with more free tokens are opened again and packed across groups

PIECES = T.ArrayType(
    T.StructType(
        [
            T.StructField("piece", T.IntegerType(), False),
            T.StructField("start", T.LongType(), False),
            T.StructField("length", T.LongType(), False),
            T.StructField("ids", T.BinaryType(), False),
        ]
    ),
    False,
)


def token_pieces(
    docs: DataFrame,
    *,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    capacity: int = CAPACITY,
    path: str | None = None,
) -> DataFrame:
    """One row per piece: ``carry``, ``piece``, ``start``, ``length`` and ``ids``, the token
    ids as little-endian unsigned 32-bit numbers.

    A document is its text's ids and a separator; null and empty texts are the separator
    alone.  Only documents longer than ``capacity`` are cut.  Each row is a document of its
    own, also where rows or ids repeat.  Carried columns may have any other names.
    """
    tail = SEPARATOR.to_bytes(4, "little")
    step = 4 * capacity

    def start():
        coder = word_coder(path)

        def compute(texts):
            rows = []
            for value in texts:
                ids = coder.ids(value or "") + tail
                cuts = range(0, len(ids), step)
                parts = [ids[c : c + step] for c in cuts]
                rows.append(
                    (
                        [
                            {"piece": i, "start": c // 4, "length": len(p) // 4, "ids": p}
                            for i, (c, p) in enumerate(zip(cuts, parts))
                        ],
                    )
                )
            return rows

        return compute

    fields = T.StructType([T.StructField("pieces", PIECES, False)])
    made = annotate(docs, [text], carry, "_made", fields, start)
    exploded = made.select(*map(column, carry), F.explode("_made.pieces").alias("_piece"))
    return exploded.select(*map(column, carry), "_piece.*")


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and the bin's final gap of each piece, taken in the given order.

    Each piece goes where the sum over gaps of the squared number of open bins becomes
    smallest: into an open bin or a new one; ties go to the tightest open bin.  Among bins of
    one gap the newest is taken.
    """
    open_bins = np.zeros(capacity + 1, np.int64)  # by gap; full bins do not count
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    gap_of: list[int] = []
    for n, size in enumerate(lengths.tolist()):
        least, chosen = 2 * open_bins[capacity - size] + 1 if size < capacity else 0, -1
        rest = np.flatnonzero(open_bins[size:])  # gaps that remain in the bins that fit
        if len(rest):
            change = 2 * (open_bins[rest] - open_bins[rest + size]) + 2
            if rest[0] == 0:
                change[0] = 1 - 2 * open_bins[size]
            best = int(np.argmin(change))
            if change[best] <= least:
                chosen = int(rest[best])
        if chosen < 0:
            chosen = capacity - size
            bins[n], offsets[n] = len(gap_of), 0
            gap_of.append(chosen)
        else:
            gap = chosen + size
            open_bins[gap] -= 1
            bins[n] = waiting[gap].pop()
            offsets[n] = capacity - gap
            gap_of[bins[n]] = chosen
        if chosen:
            open_bins[chosen] += 1
            waiting[chosen].append(int(bins[n]))
    return bins, offsets, np.asarray(gap_of, np.int64)[bins] if len(bins) else bins


def _pack_groups(pieces: DataFrame, groups: int, round_: int, capacity: int) -> DataFrame:
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    schema = T.StructType(
        [
            *pieces.schema.fields,
            T.StructField("sequence_id", T.LongType(), False),
            T.StructField("offset", T.LongType(), False),
            T.StructField("_gap", T.LongType(), False),
        ]
    )
    names = schema.fieldNames()

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_length", "_row"], ascending=[False, True])
        bins, offsets, gaps = place(frame["_length"].to_numpy(), capacity)
        group = int(frame["_group"].iloc[0])
        frame["sequence_id"] = (2 * group + round_ << 31) + bins
        frame["offset"] = offsets
        frame["_gap"] = gaps
        return frame[names]

    return dealt.groupBy("_group").applyInPandas(pack, schema)


def pack(
    pieces: DataFrame, *, length: str = "length", capacity: int = CAPACITY, group: int = GROUP
) -> DataFrame:
    """The rows of ``pieces`` with ``sequence_id`` and ``offset``.

    The number of packing groups follows the number of pieces; a piece's group comes from
    its place in the stored table, so repeated or null ids make no hot group.  Inside a group
    pieces come in falling length.  Sequences with more than ``SLACK`` free tokens are opened
    again and their pieces packed with those of other groups; as soon as all fit one group
    there is one such rest for the whole table.  Lengths lie in 1..``capacity``.  An empty
    table gives an empty one.  Columns named like the two results are an error.
    """
    clash = {"sequence_id", "offset", "_row", "_length", "_gap"} & set(pieces.columns)
    if clash:
        raise ValueError(f"columns named {sorted(clash)}; rename them first")
    kept = pieces.withColumns(
        {"_row": F.monotonically_increasing_id(), "_length": column(length).cast("long")}
    )
    stored = store(kept, "pieces")
    first = _pack_groups(
        stored.select("_row", "_length"), max(1, -(-stored.count() // group)), 0, capacity
    )
    first = store(first, "packed")
    reopened = first.where(F.col("_gap") > SLACK).select("_row", "_length")
    again = _pack_groups(reopened, max(1, -(-reopened.count() // group)), 1, capacity)
    final = first.where(F.col("_gap") <= SLACK).unionByName(again)
    places = final.select("_row", "sequence_id", "offset")
    return stored.join(places, "_row").drop("_row", "_length")


def pack_documents(docs: DataFrame) -> DataFrame:
    pieces = token_pieces(docs)
    digests = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return pack(digests)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
