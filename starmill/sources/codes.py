"""Code lists: text files of sections, each listing ``code = 'label'`` lines.

    /* I94CIT & I94RES - valid and invalid codes */
       582 =  'MEXICO'
       101 =  'ALBANIA'

A header names the fields that the lines below it apply to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.keyed import carry_down, last_per_key
from starmill.session import stage
from starmill.sources.files import arrival

# The shapes of header and entry lines, the labels that stand for "no such code",
# and the field whose labels are "city, state".
HEADER = r"(?U)^/\* (\w+(?: & \w+)*) - "
STRICT_ENTRY = r"(?U)^(\d+|'\w+')\s+=(.*)"
ENTRY = r"(?U)^(\d+|'[^']*')\s*=(.*)"
NO_SUCH_CODE = ("No PORT Code", "No Country Code")
PORT_FIELD = "I94PORT"
CITY_STATE = r"^(.*\S)\s+([A-Z]{2})(?:\s*\(.*\))?$"


def read_code_tables(
    spark: SparkSession, path: str | list[str], strict: bool = False
) -> DataFrame:
    """All code lists under ``path`` as (field, code, numeric, label, city, state).

    ``numeric`` tells whether the code was written as a number. City and state are set for port
    labels only. Of repeated codes the last counts, and a section repeated within a file
    replaces the one before.

    By default codes are trimmed, blanks before ``=`` are optional, closing semicolons are
    dropped, quoted codes stay text, and "CITY ST" without a comma is split as well. ``strict``
    turns these off: it skips entries without a blank before ``=`` or with odd codes, keeps
    semicolons, turns codes that are digits into numbers, and cuts at the last comma only.

    Lines are read as splittable text. A line's place is its file, the start of its split, and
    its position there, so even one huge file is parsed by many tasks. Places are staged, since
    several steps compare them, and so is the result, whose measured size then decides how it is
    joined.
    """
    lines = stage(spark.read.text(path).select("value", *arrival()), "code-lines")
    headed = lines.withColumn(
        "section",
        F.when(
            F.col("value").rlike(HEADER),
            F.struct(
                F.col("block"),
                F.col("line"),
                F.regexp_replace(F.regexp_extract("value", HEADER, 1), r"\s", "").alias("fields"),
            ),
        ),
    )
    carried = carry_down(headed, "section", "under", ["file"], "block", ["line"])
    entries = _entries(carried, strict)
    labelled = entries.select("field", "code", "numeric", "file", "block", "line", "label")
    current = labelled.join(_last_sections(headed), ["file", "field"]).filter(
        F.struct("block", "line") > F.col("started")
    )
    last = last_per_key(
        current.drop("started"), ["field", "code", "numeric"], ["file", "block", "line"]
    )
    city, state = _city_state(F.col("label"), strict)
    is_port = F.col("field") == PORT_FIELD
    tables = last.select(
        "field",
        "code",
        "numeric",
        "label",
        F.when(is_port, city).alias("city"),
        F.when(is_port, state).alias("state"),
    )
    return stage(tables, "codes")


def _entries(carried: DataFrame, strict: bool) -> DataFrame:
    pattern = STRICT_ENTRY if strict else ENTRY
    text = F.regexp_replace("value", r"^\s+|\s+$", "")
    listed = (
        carried.withColumn("text", text)
        .filter(F.col("text").rlike(pattern) & F.col("under").isNotNull())
        .withColumn("written", F.regexp_extract("text", pattern, 1))
        .withColumn("label", _label(F.regexp_extract("text", pattern, 2), strict))
        .withColumn("bare", F.trim(F.regexp_replace("written", "'", "")))
    )
    number = F.when(F.col("bare").rlike(r"^\d+$"), F.col("bare").try_cast("long").cast("string"))
    quoted = F.col("written").startswith("'")
    as_number = number.isNotNull() if strict else number.isNotNull() & ~quoted
    return listed.select(
        "*",
        F.when(as_number, number).otherwise(F.col("bare")).alias("code"),
        as_number.alias("numeric"),
        F.explode(F.split("under.fields", "&")).alias("field"),
    )


def _last_sections(headed: DataFrame) -> DataFrame:
    """Where the last section of each field starts, per file."""
    return (
        headed.filter(F.col("section").isNotNull())
        .select("file", "section", F.explode(F.split("section.fields", "&")).alias("field"))
        .groupBy("file", "field")
        .agg(F.max(F.struct("section.block", "section.line")).alias("started"))
    )


def _label(raw: Column, strict: bool) -> Column:
    text = F.regexp_replace(raw, "'", "")
    text = text if strict else F.regexp_replace(text, r"\s*;\s*$", "")
    text = F.regexp_replace(text, r"^\s+|\s+$", "")
    for name in NO_SUCH_CODE:
        text = F.when(F.contains(text, F.lit(name)), F.lit(name)).otherwise(text)
    return text


def _city_state(label: Column, strict: bool) -> tuple[Column, Column]:
    parts = F.split(label, ",")
    count = F.size(parts)
    city = F.array_join(F.slice(parts, F.lit(1), count - 1), ",")
    state = F.substring(F.trim(F.element_at(parts, -1)), 1, 2)
    if strict:
        return city, state
    unknown = label.isin(*NO_SUCH_CODE)
    spaced = label.rlike(CITY_STATE)
    no_comma_city = F.when(spaced, F.regexp_extract(label, CITY_STATE, 1)).otherwise(label)
    no_comma_state = F.when(spaced, F.regexp_extract(label, CITY_STATE, 2)).otherwise(F.lit(""))
    return (
        F.when(unknown, label).when(count > 1, F.trim(city)).otherwise(no_comma_city),
        F.when(unknown, F.lit("")).when(count > 1, state).otherwise(no_comma_state),
    )
