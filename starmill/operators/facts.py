"""Fact tables: joins to dimensions, single-match lookups and code labels."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions import as_column
from starmill.operators.keyed import first_per_key
from starmill.operators.nulls import drop_nulls
from starmill.session import stage


@dataclass(frozen=True)
class DimJoin:
    """How a fact reaches a dimension.

    ``on`` maps fact columns to dimension columns, ``take`` maps output names to dimension
    columns. ``null_safe`` lets null match null.
    """

    dim: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str] = field(default_factory=dict)
    how: str = "left"
    null_safe: bool = False


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    how: str = "left",
    null_safe: bool = False,
    salt: int = 1,
) -> DataFrame:
    """Join ``left`` to the columns ``take`` of ``right`` on ``left.a = right.b``.

    The strategy is left to the planner, which broadcasts by measured size only and splits hot
    keys of a shuffled join at run time. ``salt > 1`` splits them up front: each left row goes
    to one of ``salt`` parts by a hash of its values, and each right row to all of them.
    """
    keys = {f"__k{i}": F.col(b) for i, b in enumerate(on.values())}
    side = right.select(
        *[c.alias(k) for k, c in keys.items()],
        *[F.col(c).alias(f"__take_{name}") for name, c in take.items()],
    )
    pairs = list(zip(on.keys(), keys))
    match = [
        F.col(a).eqNullSafe(F.col(k)) if null_safe else F.col(a) == F.col(k) for a, k in pairs
    ]
    if salt > 1:
        if how not in ("inner", "left"):
            raise ValueError("salting is defined for inner and left joins")
        left = left.withColumn(
            "__salt", F.pmod(F.xxhash64(*left.columns), F.lit(salt)).cast("int")
        )
        side = side.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        match.append(F.col("__salt") == F.col("__part"))
    joined = left.join(side, reduce(lambda a, b: a & b, match), how).drop(
        *keys, "__salt", "__part"
    )
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.withColumnsRenamed({f"__take_{name}": name for name in take})


def key_counts(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "inner"
) -> DataFrame:
    """Rows on the left and joined rows of each key: (__k0, ..., __left, __made). Both sides are
    counted per key before anything is joined; null keys, which match nothing, are left out."""
    keys = [f"__k{i}" for i in range(len(on))]

    def counted(df: DataFrame, columns: Iterable[str], name: str) -> DataFrame:
        named = df.select(*[F.col(c).alias(k) for c, k in zip(columns, keys)])
        return named.na.drop().groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    made = F.col("__left") * F.coalesce("__right", F.lit(1))
    both = counted(left, on.keys(), "__left").join(
        counted(right, on.values(), "__right"), keys, how
    )
    return both.select(*keys, "__left", made.alias("__made"))


def hot_of(counts: DataFrame, parts: int) -> DataFrame:
    """Of ``key_counts`` the keys that make up more than one of ``parts`` even shares, with the
    number of shares: (__k0, ..., __parts)."""
    keys = [c for c in counts.columns if c.startswith("__k")]
    share = counts.agg(F.sum("__made")).scalar() / F.lit(parts)
    # More parts than rows of the left side would leave some without any.
    shares = F.least(F.ceil(F.col("__made") / share), F.col("__left")).cast("int")
    return counts.where((F.col("__made") > share) & (F.col("__left") > 1)).select(
        *keys, shares.alias("__parts")
    )


def hot_keys(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], parts: int
) -> DataFrame:
    """The keys whose joined rows are more than one of ``parts`` even shares of all joined rows,
    with the number of shares each makes up: (__k0, ..., __parts).

    There are fewer such keys than ``parts``, however large the tables are.
    """
    return hot_of(key_counts(left, right, on), parts)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    how: str = "left",
    parts: int | None = None,
    rows_per_task: int = 1 << 19,
) -> DataFrame:
    """``equi_join`` for keys that may be frequent on both sides, so that their joined rows are far
    more than the rows of either: a pre-pass counts rows per key, and only hot keys are split.

    A left row of a hot key goes to one of the key's parts by a hash of its values, a right row to
    each of them. ``parts`` is by default twice the number of shuffle partitions, or as many as
    tasks of ``rows_per_task`` joined rows. The join has that many tasks at least: the planner,
    which sees the small inputs only, would leave the many joined rows to a few.
    """
    if how not in ("inner", "left"):
        raise ValueError("splitting keys is defined for inner and left joins")
    spark = left.sparkSession
    counts = stage(key_counts(left, right, on, how), "key-counts")
    made = counts.agg(F.sum("__made")).first()[0] or 0
    tasks = -(-made // rows_per_task)
    parts = parts or max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), tasks)
    hot = stage(hot_of(counts, parts), "hot-keys")
    if tasks < 2 and hot.isEmpty():
        return equi_join(left, right, on, take, how)
    keys = [f"__k{i}" for i in range(len(on))]

    def with_parts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
        same = [F.col(c) == F.col(k) for c, k in zip(columns, keys)]
        joined = df.join(F.broadcast(hot), reduce(lambda a, b: a & b, same), "left")
        return joined.withColumn("__parts", F.coalesce("__parts", F.lit(1))).drop(*keys)

    # A left row without a whole key matches nothing wherever it is, so such rows are spread too.
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    places = F.when(whole, F.col("__parts")).otherwise(F.lit(parts))
    one = F.pmod(F.xxhash64(*left.columns), places).cast("int")
    lefts = with_parts(left, on.keys()).withColumn("__one", one).drop("__parts")
    every = F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))
    rights = with_parts(right, on.values()).withColumn("__every", every).drop("__parts")
    if tasks > 1:
        lefts = lefts.repartition(2 * tasks, *on.keys(), "__one")
        rights = rights.repartition(2 * tasks, *on.values(), "__every")
    joined = equi_join(lefts, rights, {**on, "__one": "__every"}, take, how)
    return joined.drop("__one")


def distinct_matches(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    columns: Sequence[str],
    join: Callable[..., DataFrame] = equi_join,
) -> DataFrame:
    """The distinct rows ``columns`` of ``left`` with ``take`` of ``right``, joined by an inner join.

    Both sides are made distinct before they are joined, so the joined rows, of which there may be
    far more, need no shuffle. Only for taken values that are there under several keys can two
    matches give one row; those alone are made distinct after the join.
    """
    lefts = left.select(*dict.fromkeys([*columns, *on])).distinct()
    rights = stage(
        right.select(*dict.fromkeys([*on.values(), *take.values()])).distinct(), "join-side"
    )
    taken = list(dict.fromkeys(take.values()))
    several = stage(
        rights.groupBy(*taken)
        .agg(F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
        .select(*[F.col(c).alias(f"__t{i}") for i, c in enumerate(taken)]),
        "several-keys",
    )
    out = [*columns, *take]
    if several.isEmpty():
        return join(lefts, rights, on, take, "inner").select(*out)
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__t{i}")) for i, c in enumerate(taken)]
    )
    plain = join(lefts, rights.join(several, same, "left_anti"), on, take, "inner").select(*out)
    mixed = join(lefts, rights.join(several, same, "left_semi"), on, take, "inner").select(*out)
    return plain.unionByName(mixed.distinct())


def fact(df: DataFrame, joins: Sequence[DimJoin], verify: bool = False) -> DataFrame:
    """Attach dimension columns to each row of ``df`` by a chain of joins.

    With ``verify``, dimensions whose join key repeats are refused beforehand, since each
    repeated key would multiply fact rows. Null keys never match and may repeat, unless the
    join is null-safe.
    """
    if verify:
        for join in joins:
            _refuse_repeated_keys(join)
    return reduce(
        lambda rows, j: equi_join(rows, j.dim, j.on, j.take, j.how, j.null_safe), joins, df
    )


def _refuse_repeated_keys(join: DimJoin) -> None:
    key = list(dict.fromkeys(join.on.values()))
    rows = join.dim if join.null_safe else drop_nulls(join.dim, key)
    repeated = rows.groupBy(*key).count().filter("count > 1").limit(1)
    if not repeated.isEmpty():
        raise ValueError(f"dimension is not unique by {', '.join(key)}")


def lookup_one(
    df: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    order: Sequence[str] = (),
) -> DataFrame:
    """Left join to at most one row of ``lookup``: the first by ``order`` among the matches.

    Keeps each row of ``df`` exactly once, like a query for one row per input row would, but
    as one join over all of them.
    """
    key = list(dict.fromkeys(on.values()))
    wanted = list(dict.fromkeys([*key, *take.values(), *order]))
    single = first_per_key(drop_nulls(lookup.select(*wanted), key), key, order)
    return equi_join(df, single, on, take, "left")


def with_labels(
    df: DataFrame,
    codes: DataFrame,
    field_name: str,
    code: Column | str,
    labels: Mapping[str, tuple[str, str | None]],
) -> DataFrame:
    """Add labels of one code list: ``{output: (column of codes, default when absent)}``.

    ``codes`` has one row per (field, code). The join is a broadcast whenever the list is small
    enough for one; a list of any size gives the same result.
    """
    listed = codes.filter(F.col("field") == field_name).select(
        F.col("code").alias("__listed"),
        *[F.col(c).alias(f"__label_{out}") for out, (c, _) in labels.items()],
    )
    joined = df.withColumn("__code", as_column(code)).join(
        listed, F.col("__code") == F.col("__listed"), "left"
    )
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[
            F.when(F.col("__listed").isNull(), F.lit(default).cast("string"))
            .otherwise(F.col(f"__label_{out}"))
            .alias(out)
            for out, (_, default) in labels.items()
        ],
    )
