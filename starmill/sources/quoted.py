"""Delimited text whose quoted fields may hold line breaks, read in splits.

Whether a line begins inside quotes depends on all quotes of the file before it. Only their number
matters: lines with an odd number of quotes open and close records of several lines in turn. They
are counted inside each split, and one row per split carries the counts on. A quote inside a field
is written twice, which leaves the parity as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.sources.files import arrival

PLACE = ["file", "block", "line"]


def lines_of(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """The lines of text files with their places, and whether their quotes are odd in number."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", recursive)
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    return reader.text(path).select(*arrival(), "value", (quotes % 2).alias("odd"))


def records_of(lines: DataFrame) -> DataFrame:
    """Lines put together to records: (file, block, line, value), the place of the first line.

    The lines of a split are ordered by one task, as they were read by one. Lines that are records
    by themselves are not grouped; a record of several lines is, by its number in its file.
    """
    if lines.where("odd = 1").isEmpty():
        return lines.select(*PLACE, "value")
    in_split = Window.partitionBy("file", "block").orderBy("line").rowsBetween(
        Window.unboundedPreceding, -1
    )
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    splits = lines.groupBy("file", "block").agg(F.sum("odd").alias("odds"))
    carried = splits.select(
        "file", "block", F.coalesce(F.sum("odds").over(in_file), F.lit(0)).alias("carried")
    )
    here = F.coalesce(F.sum("odd").over(in_split), F.lit(0))
    counted = (
        lines.withColumn("here", here)
        .join(carried, ["file", "block"])
        .withColumn("before", F.col("here") + F.col("carried"))
    )
    alone = (F.col("before") % 2 == 0) & (F.col("odd") == 0)
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    several = (
        counted.where(~alone)
        .groupBy("file", F.expr("before div 2").alias("record"))
        .agg(parts.alias("parts"))
        .select(
            "file",
            F.col("parts")[0]["block"].alias("block"),
            F.col("parts")[0]["line"].alias("line"),
            F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"),
        )
    )
    return counted.where(alone).select(*PLACE, "value").unionByName(several)


def read_quoted(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    recursive: bool = False,
    broken: str | None = None,
) -> DataFrame:
    """Delimited text with a header in each file, with the place of each record: the columns of
    the schema, by position, then (file, block, line).

    Line breaks inside quotes are text, and files are split all the same. A record that does not
    fit is a row of what could be read, with its text in the column ``broken`` if that is named.
    A quote that is never closed makes all that follows in its file one record, which is broken.
    Empty lines are no records.
    """
    fields = [*schema.fields, *([T.StructField(broken, T.StringType())] if broken else [])]
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    if broken:
        options["columnNameOfCorruptRecord"] = broken
    records = records_of(lines_of(spark, path, recursive))
    # Line numbers count on from split to split of a task, so the first of a file is the least.
    heads = records.groupBy("file").agg(F.min(F.struct("block", "line")).alias("head"))
    rows = records.join(heads, "file").where(F.struct("block", "line") != F.col("head"))
    text = F.regexp_replace("value", "\r$", "")
    parsed = F.from_csv(text, T.StructType(fields).toDDL(), options)
    kept = rows.where(F.trim(text) != "").select(*PLACE, parsed.alias("row"))
    return kept.select("row.*", *PLACE)
