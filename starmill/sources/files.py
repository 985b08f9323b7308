"""Typed scans of JSON, delimited and other files. A schema is given, so nothing is sampled."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.session import stage


def render_path(template: str, **params: object) -> str:
    """Fill in a templated path, such as ``log_data/{year}/{month:02d}``."""
    return template.format(**params)


def arrival() -> list[Column]:
    """Columns (file, block, line) by which the lines of scanned text files sort as they stand
    there, files in the order of their paths.

    ``line`` counts within the task that reads the split; select these next to the scan and
    stage the result before comparing places across queries.
    """
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ]


def _with_broken(reader: DataFrameReader, schema: T.StructType, broken: str | None):
    if broken is None:
        return reader.schema(schema)
    fields = [*schema.fields, T.StructField(broken, T.StringType())]
    return reader.schema(T.StructType(fields)).option("columnNameOfCorruptRecord", broken)


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    recursive: bool = False,
    pattern: str | None = None,
    mode: str = "PERMISSIVE",
    broken: str | None = None,
) -> DataFrame:
    """JSON lines, fields matched to the schema by name; ``recursive`` walks subfolders.

    A line that cannot be parsed is a row of nulls, with its text in the column ``broken`` if that
    is named; ``mode="FAILFAST"`` makes it an error.
    """
    reader = _with_broken(spark.read, schema, broken).option("mode", mode)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.json(path)


def read_json_mapped(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    mapping: Mapping[str, str],
    mode: str = "PERMISSIVE",
    broken: str | None = None,
) -> DataFrame:
    """JSON lines with an explicit ``{column: field path}`` mapping; paths may have dots. With
    ``broken`` there is also the text of lines that cannot be parsed, and the ``file``."""
    rows = read_json(spark, path, schema, mode=mode, broken=broken)
    more = [F.col(broken), arrival()[0]] if broken else []
    return rows.select(*[F.col(field).alias(name) for name, field in mapping.items()], *more)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    recursive: bool = False,
    multiline: bool = False,
    mode: str = "PERMISSIVE",
    broken: str | None = None,
) -> DataFrame:
    """Delimited text with a header in each file; the schema names columns by position.

    ``multiline`` takes line breaks inside quotes as text; files are then not split, so use it
    for files known to have them. ``mode="FAILFAST"`` makes a record that does not fit an error;
    with ``broken`` its text is in the column of that name.
    """
    reader = _with_broken(spark.read, schema, broken).options(
        header=True,
        sep=sep,
        enforceSchema=True,
        quote='"',
        escape='"',
        multiLine=multiline,
        mode=mode,
    )
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.csv(path)


def read_format(
    spark: SparkSession,
    fmt: str,
    path: str | list[str],
    schema: T.StructType | None = None,
    recursive: bool = False,
    **options: object,
) -> DataFrame:
    """Files of any format installed in the session, one of them or a whole folder tree."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(path)


def read_default(spark: SparkSession, path: str) -> DataFrame:
    """The session's default format; its column names are ``.columns`` of the result."""
    return spark.read.load(path)


def read_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Delimited text with types found by an extra scan; for exploring a file, not for jobs."""
    return spark.read.options(header=True, sep=sep, inferSchema=True).csv(path)


def stage_raw(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Keep a row-oriented source as parquet, so that later scans read only their columns."""
    return stage(df, label, path)
