"""Exploration of the raw immigration inputs before a model is made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions import parse_date
from starmill.operators.nulls import rows_with_nulls
from starmill.operators.profile import column_profile, greatest_deviation, group_sum
from starmill.operators.quality import coverage
from starmill.operators.reports import filtered_counts
from starmill.plans.immigration import HOME_COUNTRY, HOME_COUNTRY_CODE

CITY_KEY = ["city", "state"]
CITY_FIGURES = [
    "median_age", "male_population", "female_population", "total_population",
    "number_of_veterans", "foreign_born", "average_household_size",
]


def temperature_coverage(temperatures: DataFrame, year: int) -> DataFrame:
    """Records of a year, of the home country, of both, and the newest year, in one pass."""
    dated = temperatures.withColumn("year", F.year(parse_date("dt", "yyyy-MM-dd")))
    in_year, at_home = F.col("year") == year, F.col("country") == HOME_COUNTRY
    return dated.agg(
        F.count_if(in_year).alias("in_year"),
        F.count_if(in_year & at_home).alias("in_year_at_home"),
        F.count_if(at_home).alias("at_home"),
        F.max("year").alias("newest_year"),
    )


def airport_continents(airports: DataFrame) -> DataFrame:
    """Home airports, and how many of them lack or have a continent."""
    at_home = F.col("iso_country") == HOME_COUNTRY_CODE
    continent = F.col("continent")
    return filtered_counts(
        airports,
        {
            "at_home": at_home,
            "without_continent": at_home & continent.isNull(),
            "with_continent": at_home & continent.isNotNull(),
        },
    )


def explore(
    demographics: DataFrame,
    airports: DataFrame,
    temperatures: DataFrame,
    immigration: DataFrame,
    n: int = 10,
    year: int = 2016,
) -> dict[str, DataFrame]:
    """The frames of the exploration report, by title."""
    inputs = {
        "demographics": demographics,
        "airports": airports,
        "temperatures": temperatures,
        "immigration": immigration,
    }
    report = {f"profile of {name}": column_profile(df, n=n) for name, df in inputs.items()}
    report |= {
        "people counted per city": group_sum(demographics, CITY_KEY + CITY_FIGURES, ["count"]),
        "figures that vary within a city": greatest_deviation(
            demographics, CITY_KEY, CITY_FIGURES
        ),
        "demographics with nulls": rows_with_nulls(demographics),
        "airports by continent": airport_continents(airports),
        "temperatures by year": temperature_coverage(temperatures, year),
        "arrivals at a known airport": coverage(immigration, airports, ("i94port", "local_code")),
    }
    return report
