"""CSV files read by column name, whatever each file's header order (SC1, SC2).

Spark's CSV reader takes one schema for all files of a read and binds it by
position. So the headers are looked at first, in one job that reads the first
line of every file and no more; files with one header are read together, by that
header, and the groups are united by name. What comes to the driver is a line per
file, as a file listing does.
"""

from __future__ import annotations

import csv
import re
import sys
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:  # Python workers get this module's functions by value
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover
    pass


def file_headers(spark: SparkSession, path: str | list[str], glob: str | None = None) -> list[tuple[str, str]]:
    """(file, its first line) of every file that has one, by file."""
    # settings of this pass alone: a task a file
    own = spark.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", str(1 << 50))
    reader = own.read
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the line's place in its task
    lines = reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value", row.alias("row"))
    # a file cut into splits has a first line in each, the header is the one at its start
    rows = lines.where("row = 0 AND start = 0").collect()
    return sorted((r["file"], r["value"]) for r in rows)


def header_columns(line: str) -> list[str]:
    return next(csv.reader([line.lstrip("﻿").rstrip("\r")]))


def literal_path(file: str) -> str:
    """A listed file as a path to read: decoded, pattern signs escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def read_csv(
    spark: SparkSession, path: str | list[str], columns: list[str] | None = None, glob: str | None = None,
    renames: dict[str, str] | None = None, name_pattern: str | None = None, position: bool = False,
) -> DataFrame:
    """All columns as text, and ``source_file``.

    ``renames`` is applied to the header names. ``columns`` are those to keep; a
    file that lacks one is an error that names it. Without ``columns`` all files
    must have the same ones, in any order. ``name_pattern`` keeps the files whose
    name it matches. ``position`` adds ``file_row``: file, start of the split and
    row in it, which orders rows as they stand in their file, however the read
    is cut into splits and tasks.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in file_headers(spark, path, glob):
        if name_pattern and not re.match(name_pattern, unquote(file).rsplit("/", 1)[1]):
            continue
        names = tuple((renames or {}).get(c, c) for c in header_columns(line))
        groups.setdefault(names, []).append(file)
    kept = columns
    out = None
    for names, files in groups.items():
        kept = kept or list(names)
        missing = [c for c in kept if c not in names]
        if missing or (columns is None and len(names) != len(kept)):
            what = f"missing columns {missing}" if missing else f"unexpected columns {[c for c in names if c not in kept]}"
            raise ValueError(f"{files[0]}: {what} in the header")
        if len(set(names)) != len(names):
            raise ValueError(f"{files[0]}: a column name stands twice in the header")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv([literal_path(f) for f in files])
        extra = [F.col("_metadata.file_path").alias("source_file")]
        if position:
            order = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row")]
            extra.append(F.struct(*order).alias("file_row"))
        df = df.select(*kept, *extra)
        out = df if out is None else out.unionByName(df)
    if out is None:
        if kept is None:
            raise ValueError(f"no CSV file with a header in {path}")
        schema = ", ".join(f"`{c}` string" for c in [*kept, "source_file"]) + (", file_row struct<file: string, split: long, row: long>" if position else "")
        out = spark.createDataFrame([], schema)
    return out
