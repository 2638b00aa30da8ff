"""One commit for several result tables: runs in folders of their own, and a manifest.

Tables are written one after the other into a folder of the run, where no reader looks.  When
all are there, one small file names the folders that now count.  Readers follow the newest
such manifest, so a run that fails between two tables, or loses its executors, changes
nothing for them: they see all of a month or none of it.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.session import delete_path, list_folders, path_exists

PARTITIONS = ("country", "period")
_ENTRY = "table string, base string, run string, country string, period string"


@dataclass(frozen=True)
class Output:
    """A result table.  ``shared`` tables hold all markets' rows in one folder; of
    ``newest_only`` ones just the last run's months count."""

    rows: DataFrame
    shared: bool = True
    newest_only: bool = False


def _manifests(root: str, market: str) -> str:
    return f"{root}/_manifest/market={market}"


def versions(spark: SparkSession, root: str, market: str) -> list[int]:
    """Committed versions; a folder without its file was never committed."""
    found = []
    for name in list_folders(spark, _manifests(root, market)):
        number = name.removeprefix("version=")
        if path_exists(spark, f"{_manifests(root, market)}/{name}/_SUCCESS"):
            found.append(int(number))
    return sorted(found)


def _entries(spark: SparkSession, root: str, market: str, version: int | None = None) -> list:
    """The folders that count, one entry per table, country and month."""
    committed = versions(spark, root, market)
    if not committed:
        return []
    path = f"{_manifests(root, market)}/version={version or committed[-1]:012d}"
    return spark.read.schema(_ENTRY).json(path).collect()


def publish(
    spark: SparkSession, root: str, market: str, tables: Mapping[str, Output]
) -> int:
    """Write all tables of a market's run and commit them at once; returns the version.

    A month that any of the tables holds is replaced in all of them.  Of two runs of one
    market at the same time the second to commit fails, as its version exists already.
    """
    before = _entries(spark, root, market)
    committed = versions(spark, root, market)
    run, made = uuid.uuid4().hex, []
    for name, output in tables.items():
        base = f"{root}/{name}" if output.shared else f"{root}/{name}/{market}"
        path = f"{base}/run={run}"
        rows = output.rows.hint("rebalance", *PARTITIONS)
        rows.write.mode("errorifexists").partitionBy(*PARTITIONS).parquet(path)
        made += [
            (name, base, run, country, period)
            for country in list_folders(spark, path)
            for period in list_folders(spark, f"{path}/{country}")
        ]
    months = {entry[3:] for entry in made}
    newest = {name for name, output in tables.items() if output.newest_only}
    kept = [
        tuple(e)
        for e in before
        if not (e["table"] in tables and (e["table"] in newest or tuple(e)[3:] in months))
    ]
    version = (committed[-1] if committed else 0) + 1
    # One task writes one file, which appears whole when the job ends.
    spark.createDataFrame(sorted(kept + made), _ENTRY).coalesce(1).write.mode(
        "errorifexists"
    ).json(f"{_manifests(root, market)}/version={version:012d}")
    return version


def read_published(
    spark: SparkSession, root: str, name: str, market: str | None = None, version: int | None = None
) -> DataFrame | None:
    """A table as last committed, of one market or of all; None if there is none.

    ``country`` and ``period`` are text, as in the folder names.  Only the folders that count
    are listed, and tests on country and period drop the others unread.
    """
    markets = [market] if market else [
        m.removeprefix("market=") for m in list_folders(spark, f"{root}/_manifest")
    ]
    entries = [e for m in markets for e in _entries(spark, root, m, version) if e["table"] == name]
    if not entries:
        return None
    frames = []
    for base in sorted({e["base"] for e in entries}):
        paths = [
            f"{base}/run={e['run']}/{e['country']}/{e['period']}" for e in entries if e["base"] == base
        ]
        frames.append(
            spark.read.option("basePath", base).option("mergeSchema", "true").parquet(*paths)
        )
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame, allowMissingColumns=True)
    return rows.drop("run").withColumns({c: F.col(c).cast("string") for c in PARTITIONS})


def vacuum(spark: SparkSession, root: str, market: str, keep: int = 2) -> int:
    """Delete the market's manifests before the last ``keep`` and the runs that none of those
    left, nor another market's, names; returns how many runs went.  Not while a run is
    publishing."""
    committed = versions(spark, root, market)
    kept, gone = committed[-keep:], committed[:-keep]
    bases, used = set(), set()
    for name in list_folders(spark, f"{root}/_manifest"):
        other = name.removeprefix("market=")
        for version in versions(spark, root, other):
            entries = _entries(spark, root, other, version)
            bases |= {e["base"] for e in entries if other == market}
            if other != market or version in kept:
                used |= {(e["base"], e["run"]) for e in entries}
    count = 0
    for base in bases:
        for folder in list_folders(spark, base):
            if folder.startswith("run=") and (base, folder.removeprefix("run=")) not in used:
                delete_path(spark, f"{base}/{folder}")
                count += 1
    for version in gone:
        delete_path(spark, f"{_manifests(root, market)}/version={version:012d}")
    return count
