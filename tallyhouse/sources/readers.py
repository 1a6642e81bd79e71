"""Files to all-text raw rows.

Files are read together only if their columns are laid out alike: a CSV reader
given one schema for files with different column orders would mix the columns
without a word.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import null_tokens, plain_text
from ..specs import source


def _any_fault(checks: Sequence[Column]) -> Column:
    return F.nullif(F.concat_ws("; ", *checks), F.lit(""))


def _too_long(name: str) -> list[Column]:
    return [
        F.when(F.length(f.name) > f.length, F.lit(f"value too long for {f.name} ({f.length})"))
        for f in source(name).fields
    ]


def _in_order(df: DataFrame, name: str, fault: Column) -> DataFrame:
    """The source's columns, absent optional ones as NULL, with file path and fault."""
    have = set(df.columns)
    columns = [F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in source(name).columns]
    return df.select(*columns, "_file", fault.alias("_fault"))


def literal_path(path: str) -> str:
    """The path with its pattern characters escaped, so that a reader takes it as a name."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


# Files of at most so many bytes are read by one task each, which is what a split would be anyway.
SPLIT_BYTES = 128 << 20

# Stands for a quoted cell; lines that hold it are not taken for closed.
_CELL = "\x01"


def closed(line: Column) -> Column:
    """Whether a line is a row on its own: quotes only around whole cells, and none left open.

    If that holds for every line of a file, then from its first line on no quoted cell spans two. Control
    characters, carriage returns but for one at the end included, leave it open: readers differ on them.
    """
    cells = F.regexp_replace(F.regexp_replace(line, "\r$", ""), '"[^"]*"', _CELL)  # "a""b" is two, side by side
    odd = F.regexp_replace(line, "\r$", "").rlike(r"[\x00-\x08\x0A-\x1F]")
    return ~(odd | cells.contains('"') | cells.rlike(rf"[^,{_CELL}]{_CELL}|{_CELL}[^,{_CELL}]"))


def closed_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of the files whose every line is a row on its own, as the reader names them.

    One pass over their lines in splits; one row per file comes back.
    """
    lines = spark.read.option("lineSep", "\n").text([literal_path(p) for p in paths])
    ends = F.col("value").endswith("\r")
    # All lines must end alike, the last one included: the stream reader goes by the first line end it sees.
    alike = F.count_if(ends) * F.count_if(~ends) == 0
    found = lines.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.bool_and(closed(F.col("value"))).alias("c"), alike.alias("a"))
    return [r["f"] for r in found.filter("c and a").collect()]


def read_csv_files(
    spark: SparkSession, paths: Sequence[str], name: str, header: Sequence[str], by_lines: bool = False
) -> DataFrame:
    """Rows of CSV files that share one header, as text, with ``_file`` and ``_fault``.

    A file is read by one task, as a stream: quoted cells may span lines, so no place in a file but its
    start is known to start a row. With ``by_lines``, for files that ``closed_files`` names, Spark splits
    them instead; the rows are the same. Blank lines are no rows. Missing cells at the end of a row are
    NULL. A row with more cells than the header, or a value longer than the raw column, is a fault.
    """
    taken: dict[str, int] = {}
    names = []
    for column in header:  # a repeated name gets a number, as its values are not the first one's
        seen = taken.get(column, 0)
        taken[column] = seen + 1
        names.append(f"{column}.{seen}" if seen else column)
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_record", "maxCharsPerColumn": "-1"}
    fields = [T.StructField(c, T.StringType()) for c in (*names, "_record")]
    rows = (
        spark.read.schema(T.StructType(fields)).options(**options)
        .option("header", "true").option("multiLine", str(not by_lines).lower())
        .csv([literal_path(p) for p in paths])
        .withColumn("_file", F.col("_metadata.file_path"))
    )
    # A short row keeps its text in _record; that of a one-column file is its only cell.
    line = F.coalesce("_record", F.col(f"`{names[0]}`")) if len(names) == 1 else F.col("_record")
    rows = rows.filter(line.isNull() | (F.trim(F.translate(line, "\r\n\t", "   ")) != ""))
    quoted = r'"(?:[^"]|"")*"'
    cells = F.size(F.split(F.regexp_replace("_record", quoted, ""), ",", -1))
    wide = F.when(F.col("_record").isNotNull() & (cells > len(names)), F.lit("row has more cells than the header"))
    wanted = [c for c in source(name).columns if c in names]
    clean = rows.select(*[null_tokens(F.col(f"`{c}`")).alias(c) for c in wanted], "_file", wide.alias("_wide"))
    for c in set(source(name).columns) - set(wanted):
        clean = clean.withColumn(c, F.lit(None).cast("string"))
    return _in_order(clean, name, _any_fault([F.col("_wide"), *_too_long(name)]))


def read_parquet_files(spark: SparkSession, paths: Sequence[str], name: str) -> DataFrame:
    """Rows of Parquet files of one layout, every value as text, with ``_file`` and ``_fault``."""
    rows = spark.read.parquet(*[literal_path(p) for p in paths])
    types = {f.name: f.dataType for f in rows.schema.fields}
    wanted = [c for c in source(name).columns if c in types]
    text = rows.select(*[plain_text(F.col(c), types[c]).alias(c) for c in wanted],
                       F.col("_metadata.file_path").alias("_file"))
    for c in set(source(name).columns) - set(wanted):
        text = text.withColumn(c, F.lit(None).cast("string"))
    return _in_order(text, name, _any_fault(_too_long(name)))
