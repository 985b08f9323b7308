"""Joins of facts to dimensions, lookups, code labels, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog import derived
from starmill.catalog.registry import query
from starmill.functions import code_text
from starmill.operators.dims import project, surrogate_key
from starmill.operators.facts import DimJoin, equi_join, fact, lookup_one, with_labels
from starmill.operators.quality import coverage


def _plays(t):
    """Line items as plays: the part played, its brand, and a price of its own for some."""
    sold = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_returnflag")
    price = F.col("p_retailprice") + F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    return sold.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_shipdate",
        F.col("p_name").alias("song"),
        F.col("p_brand").alias("artist"),
        price.alias("length"),
    )


_PLAYS_SQL = """WITH plays AS (
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, p_name AS song, p_brand AS artist,
           p_retailprice + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS length
    FROM lineitem JOIN part ON l_partkey = p_partkey)
"""

_FANOUT_SQL = """
WITH artists AS (SELECT DISTINCT p_brand AS name, p_type AS genre FROM part)
SELECT p_partkey, p_name, genre FROM part JOIN artists ON p_brand = name
"""


def _genres(t):
    return project(t.part, {"name": "p_brand", "genre": "p_type"}).distinct()


@query(_FANOUT_SQL)
def join_inner_fanout(t):
    songs = t.part.select("p_partkey", "p_name", "p_brand")
    return equi_join(songs, _genres(t), {"p_brand": "name"}, {"genre": "genre"}, "inner").drop(
        "p_brand"
    )


@query(_FANOUT_SQL)
def join_inner_salted(t):
    """The same join with its keys split up front."""
    songs = t.part.select("p_partkey", "p_name", "p_brand")
    on, take = {"p_brand": "name"}, {"genre": "genre"}
    return equi_join(songs, _genres(t), on, take, "inner", salt=4).drop("p_brand")


@query(_PLAYS_SQL + """
SELECT l_orderkey, l_linenumber, l_shipdate, song, p_partkey AS song_id
FROM plays LEFT JOIN part ON song = p_name AND artist = p_brand AND length = p_retailprice
""")
def join_left_3key(t):
    on = {"song": "p_name", "artist": "p_brand", "length": "p_retailprice"}
    plays = _plays(t).select("l_orderkey", "l_linenumber", "l_shipdate", *on)
    return equi_join(plays, t.part, on, {"song_id": "p_partkey"}).drop("artist", "length")


@query(_PLAYS_SQL + """, artists AS (SELECT DISTINCT p_brand AS artist_id, p_brand AS name FROM part),
songs AS (SELECT p_name AS title, name, min(p_partkey) AS song_id
          FROM part JOIN artists ON p_brand = artist_id GROUP BY ALL)
SELECT l_orderkey, l_linenumber, song, artist, song_id
FROM plays LEFT JOIN songs ON song = title AND artist = name
""", name="lookup_one")
def lookup_one_song(t):
    """Songs joined to artists, and of those of the same title and artist only the first."""
    artists = project(t.part, {"artist_id": "p_brand", "name": "p_brand"}).distinct()
    songs = equi_join(t.part, artists, {"p_brand": "artist_id"}, {"name": "name"}, "inner")
    plays = _plays(t).select("l_orderkey", "l_linenumber", "song", "artist")
    on = {"song": "p_name", "artist": "name"}
    return lookup_one(plays, songs, on, {"song_id": "p_partkey"}, ["p_partkey"])


@query("""
WITH prices AS (SELECT o_custkey, round(avg(o_totalprice), 8) AS mean_price FROM orders
                WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT c_custkey, c_name, mean_price
FROM customer LEFT JOIN prices ON c_custkey = o_custkey
""")
def join_left_dim(t):
    prices = t.orders.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(
        F.round(F.avg("o_totalprice"), 8).alias("mean_price")
    )
    return equi_join(
        t.customer.select("c_custkey", "c_name"),
        prices,
        {"c_custkey": "o_custkey"},
        {"mean_price": "mean_price"},
    )


_OUTER_SQL = """
WITH states AS (SELECT n_nationkey AS nation, n_regionkey AS region, n_name FROM nation
                WHERE n_regionkey < 3),
seen AS (SELECT DISTINCT s_nationkey AS nation, n_regionkey AS region
         FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0)
SELECT nation, region, n_name FROM states FULL JOIN seen USING (nation, region)
"""


def _outer(t):
    nation = t.nation.withColumnsRenamed({"n_nationkey": "nation", "n_regionkey": "region"})
    seen = t.supplier.filter("s_acctbal > 0").select(F.col("s_nationkey").alias("nation"))
    seen = seen.distinct().join(nation.drop("n_name"), "nation")
    return nation.filter("region < 3").join(seen, ["nation", "region"], "full_outer")


@query(_OUTER_SQL)
def join_full_outer_using(t):
    return _outer(t).select("nation", "region", "n_name")


@query(_OUTER_SQL + "WHERE n_name <> 'NATION_7'")
def join_outer_then_filter(t):
    """The filter on one side's column makes the planner preserve that side only."""
    return _outer(t).select("nation", "region", "n_name").filter("n_name <> 'NATION_7'")


@query("""
SELECT o_orderkey, o_orderdate, c_name AS customer, n_name AS nation, o_orderstatus AS status,
       coalesce(n_regionkey, -1)::INTEGER AS region
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 4
""")
def star_fact(t):
    """Orders joined to three dimensions, over generated keys and a compound condition."""
    nations = surrogate_key(t.nation.filter("n_regionkey < 4"), ["n_nationkey"], "nation_id")
    people = equi_join(
        surrogate_key(t.customer, ["c_custkey"], "customer_id"),
        nations,
        {"c_nationkey": "n_nationkey"},
        {"nation_id": "nation_id"},
    )
    statuses = surrogate_key(
        t.orders.select(F.col("o_orderstatus").alias("status")).distinct(), ["status"], "status_id"
    )
    keyed = fact(
        t.orders,
        [
            DimJoin(
                people,
                {"o_custkey": "c_custkey"},
                {"customer_id": "customer_id", "nation_id": "nation_id"},
            ),
            DimJoin(statuses, {"o_orderstatus": "status"}, {"status_id": "status_id"}),
        ],
        verify=True,
    ).select("o_orderkey", "o_orderdate", "customer_id", "nation_id", "status_id")
    named = fact(
        keyed,
        [
            DimJoin(
                people,
                {"customer_id": "customer_id", "nation_id": "nation_id"},
                {"customer": "c_name"},
                null_safe=True,
            ),
            DimJoin(
                nations, {"nation_id": "nation_id"}, {"nation": "n_name", "region": "n_regionkey"}
            ),
            DimJoin(statuses, {"status_id": "status_id"}, {"status": "status"}),
        ],
    )
    region = F.coalesce("region", F.lit(-1)).alias("region")
    return named.select("o_orderkey", "o_orderdate", "customer", "nation", "status", region)


@query("WITH " + derived.LABELS_SQL + """
SELECT c_custkey, coalesce(label, 'No Country Code') AS country,
       CASE WHEN n_regionkey < 4 THEN n_name ELSE 'No PORT Code' END AS city,
       CASE WHEN n_regionkey < 4 THEN r_name[1:2] ELSE '' END AS state
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey LEFT JOIN countries ON code = c_nationkey
""")
def code_label_lookup(t):
    """Code lists written as text, parsed, and joined, with defaults for missing codes."""
    codes = derived.codes(t)
    people = t.customer.select(
        "c_custkey",
        F.col("c_nationkey").cast("double").alias("i94cit"),
        F.concat(F.lit("P"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("port"),
    )
    country = {"country": ("label", "No Country Code")}
    place = {"city": ("city", "No PORT Code"), "state": ("state", "")}
    labelled = with_labels(people, codes, "I94CIT", code_text("i94cit"), country)
    return with_labels(labelled, codes, "I94PORT", "port", place).drop("i94cit", "port")


@query("""
SELECT count(c_custkey) AS matched, count(*) AS total, count(c_custkey) / count(*) AS ratio
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment <> 'BUILDING'
""")
def match_ratio(t):
    known = t.customer.filter("c_mktsegment <> 'BUILDING'")
    return coverage(t.orders, known, ("o_custkey", "c_custkey"))
