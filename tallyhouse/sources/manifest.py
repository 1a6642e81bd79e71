"""Which files are there, what is in them, and are they fit to load.

One row per file. Contents are hashed and headers read by the executors; only
names and sizes ever describe a file on the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import file_date, file_extension
from ..specs import SUPPORTED_EXTENSIONS, lookup
from .readers import closed, literal_path

# Larger files are hashed as a stream instead of as one value, of which a task holds several copies.
WHOLE_FILE_BYTES = 32 << 20
# The same for stores that the stream reader may not know, though Spark does.
OTHER_STORE_BYTES = 512 << 20
_STREAMED = ("file", "s3", "s3a", "s3n")

MANIFEST = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("load_path", T.StringType()),
    T.StructField("file_size_bytes", T.LongType()),
    T.StructField("checksum", T.StringType()),
    T.StructField("file_columns", T.ArrayType(T.StringType())),
    T.StructField("layout", T.StringType()),
    T.StructField("content_fault", T.StringType()),
])

# What a file says that can't be taken in at all.
NOT_UTF8 = "File is not valid UTF-8"


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Path and size of every file below the given folders; contents stay unread."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .load([paths] if isinstance(paths, str) else list(paths))
        .select(F.col("_metadata.file_path").alias("file_path"), F.col("path").alias("load_path"),
                F.col("length").alias("file_size_bytes"))
    )


def recognise(files: DataFrame, root: str) -> DataFrame:
    """Files that sit directly in a source's folder and carry its extension.

    Adds the source and the file name. Dot-files and other extensions (the
    case counts) are left out.
    """
    base = re.sub(r"^file:/*(?=/)", "", root.rstrip("/"))
    pattern = rf"\Q{base}\E/([^/]+)/([^/]+)$"
    source = F.regexp_extract("load_path", pattern, 1)
    name = F.regexp_extract("load_path", pattern, 2)
    return (
        files.withColumns({"source_name": source, "file_name": name})
        .filter(F.col("file_name").endswith(lookup(F.col("source_name"), lambda s: s.extension)))
        .filter(~F.col("file_name").startswith("."))
    )


def checksum(content: Column) -> Column:
    """SHA-256 of the content in hex; NULL for empty content, which has none to compare."""
    return F.when(F.length(content) > 0, F.sha2(content, 256))


def csv_header(line: Column) -> Column:
    """Column names of a CSV header line."""
    cells = F.regexp_extract_all(F.regexp_replace(line, "^\ufeff", ""), F.lit(r'(?:\A|,)("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    return F.transform(cells, lambda c: F.when(
        c.startswith('"'), F.replace(F.regexp_extract(c, r'(?s)^"(.*)"$', 1), F.lit('""'), F.lit('"'))).otherwise(c))


# The header is the first record that is not blank. Both ways to read a file go by this.
_BLANK = r"\A\ufeff?(?:[ \t\r\n]*[\r\n])?"


def _first_line(text: Column) -> Column:
    return F.regexp_extract(text, _BLANK + r"([^\r\n]*)", 1)


def _record_rule():
    """``rule(text, whole)``: the first record of a file's beginning, None if it goes on behind it.

    Quotes around a cell may hold line breaks; quotes elsewhere are text. If a quoted cell never ends, the
    first line is the record. Nested, so that workers get it without this package.
    """
    import re

    cell = r'(?:"(?:[^"]|"")*"[^,\r\n]*|[^",\r\n][^,\r\n]*|)'
    record = re.compile(rf"{_BLANK}({cell}(?:,{cell})*)(?=[\r\n]|\Z)")
    line = re.compile(rf"{_BLANK}([^\r\n]*)")

    def rule(text: str, whole: bool) -> str | None:
        met = record.match(text)
        if met and (whole or met.end() < len(text)):
            return met[1]
        return line.match(text)[1] if whole else None

    return rule


def _open_headers():
    """The first record of texts whose first line leaves a quoted cell open."""
    rule = _record_rule()

    def read(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else rule(t, True))

    return F.pandas_udf(read, "string")


def _parquet_tail(content: Column, size: Column) -> Column:
    """The end of a Parquet file: metadata, its length (4 bytes, low byte first) and the magic word."""
    digits = F.hex(F.substring(content, -8, 4))
    length = F.conv(F.concat(*[F.substring(digits, at, 2) for at in (7, 5, 3, 1)]), 16, 10).cast("bigint")
    ends_well = (size > 12) & (F.substring(content, -4, 4) == F.lit(b"PAR1")) & (length + 8 < size)
    return F.when(ends_well, content.substr((size - length - 7).cast("int"), (length + 8).cast("int"))).otherwise(F.lit(b""))


def _footer_reader():
    """Schema from the tail of a Parquet file: {names, layout}, NULL if unreadable."""

    def read(tails: pd.Series) -> pd.DataFrame:
        import io

        import pyarrow.parquet as pq

        names, layouts = [], []
        for tail in tails:
            try:
                schema = pq.read_schema(io.BytesIO(b"PAR1" + tail))
                names.append(list(schema.names))
                layouts.append(", ".join(f"{f.name}:{f.type}" for f in schema))
            except Exception:  # noqa: BLE001 - an unreadable footer marks the file, whatever the cause
                names.append(None)
                layouts.append(None)
        return pd.DataFrame({"names": names, "layout": layouts})

    return F.pandas_udf(read, "names array<string>, layout string")


def _stream_reader():
    """Checksum and header of files too large for one value, read in pieces. What goes wrong marks the file."""
    rule, not_utf8 = _record_rule(), NOT_UTF8

    def read(batches: Iterator) -> Iterator:
        import codecs
        import hashlib
        import re

        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for file_path, load_path, size in zip(batch.file_path, batch.load_path, batch.file_size_bytes):
                digest, start, asked, line, names, layout, fault = hashlib.sha256(), "", 0, None, None, None, None
                is_csv = not load_path.endswith(".parquet")
                decoder = codecs.getincrementaldecoder("utf-8")()
                try:
                    uri = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", load_path))
                    filesystem, inner = pafs.FileSystem.from_uri(uri)
                    with filesystem.open_input_stream(inner) as stream:
                        while piece := stream.read(8 << 20):
                            digest.update(piece)
                            if is_csv and fault is None:
                                try:
                                    text = decoder.decode(piece)
                                    if line is None:
                                        start += text
                                        # A header that goes on and on is asked for again at twice the length.
                                        if len(start) >= 2 * asked:
                                            asked, line = len(start), rule(start, False)
                                except UnicodeDecodeError:
                                    fault = not_utf8
                    if is_csv and fault is None:
                        try:
                            decoder.decode(b"", final=True)
                        except UnicodeDecodeError:
                            fault = not_utf8
                    if is_csv and line is None:
                        line = rule(start, True)
                    if not is_csv:
                        with filesystem.open_input_file(inner) as f:
                            schema = pq.read_schema(f)
                        names, layout = list(schema.names), ", ".join(f"{f.name}:{f.type}" for f in schema)
                except Exception as e:  # noqa: BLE001 - an unreadable file must not stop the others
                    fault = fault or (f"Could not read file: {e}" if is_csv else None)
                rows.append((file_path, load_path, size, digest.hexdigest(), line, names, layout, fault))
            yield pd.DataFrame(
                rows, columns=["file_path", "load_path", "file_size_bytes", "checksum", "line", "names", "layout", "content_fault"])

    return read


def _files(spark: SparkSession, paths: str | Sequence[str], pattern: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        .load([paths] if isinstance(paths, str) else [literal_path(p) for p in paths])
        .select(F.col("_metadata.file_path").alias("file_path"), F.col("path").alias("load_path"),
                F.col("length").alias("file_size_bytes"), "content")
    )


def _streamed(spark: SparkSession, paths: Sequence[str]) -> bool:
    """Whether all paths are in stores that the stream reader opens."""
    usual = spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return all((re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", p) or re.match(r"([^:]*):", usual))[1].lower() in _STREAMED for p in paths)


def fingerprint(
    spark: SparkSession, paths: str | Sequence[str], whole_file_bytes: int = WHOLE_FILE_BYTES
) -> DataFrame:
    """Every CSV and Parquet file with its checksum and its column names.

    Empty files are not listed; unreadable ones have no columns. Each file is
    read once. The length filters reach the reader, which then skips contents.
    """
    content, size = F.col("content"), F.col("file_size_bytes")
    if not _streamed(spark, [paths] if isinstance(paths, str) else paths):
        whole_file_bytes = max(whole_file_bytes, OTHER_STORE_BYTES)
    facts = ["file_path", "load_path", "file_size_bytes"]
    parts = []
    for pattern in ("*.csv", "*.parquet"):
        is_csv = pattern == "*.csv"
        files = _files(spark, paths, pattern)
        whole = files.filter(size <= whole_file_bytes)
        if is_csv:
            text = content.cast("string")
            valid = F.is_valid_utf8(text)
            # The header is the first record of the whole file, however long. Nearly always its first line is one.
            whole = whole.select(*facts, checksum(content).alias("checksum"), F.when(valid, _first_line(text)).alias("line"),
                                 F.when(valid & ~closed(_first_line(text)), text).alias("open"),
                                 F.when(~valid, F.lit(NOT_UTF8)).alias("content_fault"))
            whole = whole.withColumns({"file_columns": csv_header(F.coalesce(_open_headers()("open"), "line")),
                                       "layout": F.lit(None).cast("string")})
        else:
            whole = whole.select(*facts, checksum(content).alias("checksum"), _parquet_tail(content, size).alias("tail"))
            whole = whole.withColumn("_schema", _footer_reader()("tail")).withColumns(
                {"file_columns": F.col("_schema.names"), "layout": F.col("_schema.layout"), "content_fault": F.lit(None).cast("string")})
        parts.append(whole.select(*MANIFEST.names))
        large = files.filter(size > whole_file_bytes).select(*facts)
        if large.isEmpty():
            continue
        streamed = large.mapInPandas(
            _stream_reader(), "file_path string, load_path string, file_size_bytes long, checksum string, line string,"
                              " names array<string>, layout string, content_fault string")
        names = csv_header(F.col("line")) if is_csv else F.col("names")
        parts.append(streamed.withColumn("file_columns", names).select(*MANIFEST.names))
    return reduce(DataFrame.unionByName, parts)


def dated(files: DataFrame) -> DataFrame:
    """Adds the file type and the date its name carries."""
    return files.withColumns({
        "file_type": F.regexp_replace(file_extension(F.col("file_name")), r"^\.", ""),
        "file_date": file_date(F.col("file_name")),
    })


def validated(files: DataFrame) -> DataFrame:
    """Adds the missing required columns, ``is_valid`` and the first problem found.

    Order: extension, source, size, readability, columns. Extra columns pass.
    """
    extension, size = file_extension(F.col("file_name")), F.col("file_size_bytes")
    fault = F.col("content_fault") if "content_fault" in files.columns else F.lit(None).cast("string")
    required = lookup(F.col("source_name"), lambda s: s.required)  # NULL for an unknown source
    first_look = (
        F.when(~extension.isin(*SUPPORTED_EXTENSIONS), F.concat(F.lit("Unsupported file type '"), extension, F.lit("'")))
        .when(required.isNull(), F.concat(F.lit("Unknown source name '"), F.coalesce("source_name", F.lit("")), F.lit("'")))
        .when(size == 0, F.concat(F.lit("File is empty: "), F.col("file_name")))
        .when(fault.isNotNull(), F.concat(fault, F.lit(": "), F.col("file_name")))
        .when(F.col("file_columns").isNull(), F.concat(F.lit("Could not read file columns: "), F.col("file_name")))
    )
    missing = F.when(F.col("validation_error").isNull(), F.array_except(required, F.col("file_columns"))) \
        .otherwise(F.array().cast("array<string>"))
    error = F.coalesce("validation_error", F.when(
        F.size("missing_columns") > 0,
        F.concat(F.lit("Missing required columns: "), F.array_join("missing_columns", ", "))))
    return (
        files.withColumn("validation_error", first_look)
        .withColumn("missing_columns", missing)
        .withColumn("validation_error", error)
        .withColumn("is_valid", F.col("validation_error").isNull())
    )
