"""Call lists edited by staff and dropped as text files, one folder per country."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from holdfast.session import store

# The note columns that staff edit and the next run carries over.
NOTE_COLUMNS = (
    "Estado",
    "Fecha_planificada",
    "telefono_alternativo",
    "nombre_persona_contactada",
    "motivo_contacto_fallido",
    "estado_propuesta",
    "valor_propuesta",
    "motivo_venta_nocerrada",
    "observaciones",
    "fecha_ultima_accion",
)

REQUIRED = ("client_id", "row_no", *NOTE_COLUMNS)


@dataclass
class Feedback:
    """Lines of the files that can be read, and the files that are held back.

    ``quarantine`` has a row per file: ``country``, ``file``, ``header`` and ``reason``.
    """

    rows: DataFrame
    quarantine: DataFrame


_QUARANTINE = "country string, file string, header string, reason string"


def first_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``country``, ``file`` and ``header``, the first line with text, of each file.

    Lines are numbered as they are read, and those of a file's first part reduced to the
    first in the task that reads it; a file without text has no row.
    """
    lines = spark.read.text(folder)
    return (
        lines.select(
            F.col("country").cast("string").alias("country"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("_start"),
            "value",
            F.monotonically_increasing_id().alias("_place"),
        )
        .where((F.col("_start") == 0) & (F.trim("value") != ""))
        .groupBy("country", "file")
        .agg(F.min_by("value", "_place").alias("header"))
    )


def header_names(header: str) -> list[str]:
    return next(csv.reader([header.removeprefix("\ufeff")]))


def header_fault(names: Sequence[str]) -> str | None:
    """Why a file with these columns cannot be read, or None."""
    missing = [c for c in REQUIRED if c not in names]
    if missing:
        return "lacks " + ", ".join(missing)
    twice = [c for c in REQUIRED if list(names).count(c) > 1]
    return "repeats " + ", ".join(twice) if twice else None


def read_feedback(spark: SparkSession, folder: str) -> Feedback:
    """All countries' files; ``country`` comes from the folder names.

    Columns are taken by the names in each file's own header, in any order, and others are
    left out, so that an exported list comes back as it went out.  A file whose header lacks
    or repeats a column is held back with the reason, and so are the other files of that
    country, since half a list would take the place of a whole one; other countries are read
    as if it were not there.  A line of another length keeps its text in ``_corrupt_record``
    and stops nothing else.

    Files of one header are read together.  What reaches the driver is a line per file.
    """
    files = [
        (r["country"], unquote(r["file"]), r["header"])
        for r in first_lines(spark, folder).collect()
    ]
    seen = {_plain(file) for _, file, _ in files}
    given = [unquote(f) for f in spark.read.text(folder).inputFiles()]
    empty = [file for file in given if _plain(file) not in seen]
    faults = {file: header_fault(header_names(header)) for _, file, header in files}
    held = {country: fault for country, file, _ in sorted(files) if (fault := faults[file])}
    quarantine = [
        (country, file, header, faults[file] or "another file of the country is held back")
        for country, file, header in files
        if country in held
    ]
    for file in empty:
        country = next((p[8:] for p in file.split("/") if p.startswith("country=")), None)
        quarantine.append((country, file, None, "holds no line"))
    by_header: dict[str, list[str]] = {}
    for country, file, header in files:
        if country not in held:
            by_header.setdefault(header, []).append(file)
    frames = [
        _lines(spark, folder, header_names(header), sorted(paths))
        for header, paths in sorted(by_header.items())
    ]
    if not frames:
        frames = [spark.createDataFrame([], _schema(REQUIRED))]
    # Which lines are corrupt depends on the columns a plan reads: all are read here, once.
    number = {c: F.expr(f"try_cast(`{c}` AS BIGINT)") for c in ("client_id", "row_no")}
    wanted = [number.get(c, F.col(c)).alias(c) for c in REQUIRED]
    frames = [
        store(f, "feedback").select(*wanted, "_corrupt_record", "country") for f in frames
    ]
    return Feedback(
        reduce(DataFrame.unionByName, frames), spark.createDataFrame(quarantine, _QUARANTINE)
    )


def _plain(path: str) -> str:
    """A path's two spellings, with one slash after the scheme and with more, as one."""
    scheme, _, rest = path.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}"


def _schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in (*names, "_corrupt_record", "country")])


def _lines(spark: SparkSession, folder: str, names: Sequence[str], paths: list[str]) -> DataFrame:
    named = [c if c in REQUIRED else f"_other_{i}" for i, c in enumerate(names)]
    return (
        spark.read.schema(_schema(named))
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("emptyValue", "")
        .option("nullValue", "\\N")
        .option("basePath", folder)
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .csv(paths)
    )


def split_feedback(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rows rejected for their length, client or row number."""
    usable = (
        F.col("_corrupt_record").isNull()
        & F.col("client_id").isNotNull()
        & F.col("row_no").isNotNull()
    )
    return df.where(usable).drop("_corrupt_record"), df.where(~usable)
