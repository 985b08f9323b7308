"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmill.functions.columns import as_column


def upper_text(c: Column | str) -> Column:
    return F.upper(as_column(c))


def pair_part(c: Column | str, index: int, sep: str = ",", as_type: str | None = None) -> Column:
    """Part ``index`` of a "lon, lat" like text; null if it has fewer parts."""
    part = F.get(F.split(as_column(c), F.lit(sep)), F.lit(index))
    return F.trim(part).try_cast(as_type) if as_type else part


def code_text(c: Column | str) -> Column:
    """A numeric code as text: data files hold integer codes as doubles (582.0 is "582")."""
    return as_column(c).try_cast("long").cast("string")


def fallback_identifier(
    number: Column | str, company: Column | str, mode: Column | str, strict: bool = False
) -> Column:
    """A transport number, or else "no" + three letters of the company + the mode.

    ``strict`` keeps the original rule, under which a known company always gives a plain "no"
    and the mode counts only without one.
    """
    number, company, mode = as_column(number).cast("string"), as_column(company), as_column(mode)
    letters = F.coalesce(F.substring(company, 1, 3), F.lit(""))
    mode_text = F.when(mode.try_cast("double") == 0, None).otherwise(mode.cast("string"))
    mode_text = F.coalesce(mode_text, F.lit(""))
    if strict:
        built = F.when(letters != "", F.lit("no")).otherwise(F.concat(F.lit("no"), mode_text))
    else:
        built = F.concat(F.lit("no"), letters, mode_text)
    return F.coalesce(F.nullif(number, F.lit("")), built)
