"""Writing tables: full refresh, append, insert-ignore, upsert, last write wins, layouts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators.contracts import Load, refuse
from starmill.operators.dataset import Dataset, Files
from starmill.operators.keyed import first_per_key, last_per_key
from starmill.schemas import TableSpec


# -- files -----------------------------------------------------------------------------------


def rebalanced(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Even out the written files, bringing equal ``by`` values together.

    The adaptive planner sizes the partitions at run time: it merges small ones and splits the
    one that a frequent value fills, which a plain repartition would leave to a single task.
    """
    return df.hint("rebalance", *[F.col(c) for c in by])


def overwrite(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    even: bool = True,
    compression: str | None = None,
) -> None:
    """Write a folder anew. ``even=False`` leaves out the shuffle that evens out the files of a
    partitioned table, for rows that already lie in tasks of a bounded size."""
    rows = rebalanced(df, partition_by) if partition_by and even else df
    writer = rows.write.mode("overwrite").partitionBy(*partition_by)
    writer.parquet(path, compression=compression)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    rows = rebalanced(df, partition_by) if partition_by else df
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_folders(spark: SparkSession, moves: Mapping[str, str]) -> None:
    """Put written folders, ``{target: written}``, in place of their targets. What was there is
    moved aside first and comes back if a move fails; it goes once all are in place."""
    done: list[tuple[str, str | None]] = []
    files = None
    try:
        for target, written in moves.items():
            files = Files(spark, target)
            aside = f"{written}.old" if files.exists(target) else None
            if aside:
                files.move(target, aside)
            done.append((target, aside))
            files.move(written, target)
    except Exception:
        for target, aside in reversed(done):
            if aside:
                files.delete(target)
                files.move(aside, target)
        raise
    for _, aside in done:
        if aside:
            files.delete(aside)


def remove_folder(spark: SparkSession, path: str) -> None:
    Files(spark, path).delete(path)


def save_report(df: DataFrame, path: str) -> None:
    """A CSV report with a header; an existing target is an error."""
    df.write.mode("errorifexists").option("header", True).csv(path)


def save_quoted_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with every field quoted. ``one_file`` is for small extracts only."""
    rows = df.coalesce(1) if one_file else df
    rows.write.mode("overwrite").options(
        header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=True
    ).csv(path)


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or no rows if nothing has been written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# -- catalog tables --------------------------------------------------------------------------


def create_tables(
    spark: SparkSession, specs: Iterable[TableSpec], location: str, database: str = "default"
) -> None:
    """Create the tables that do not exist yet, each in a folder of its own."""
    for spec in specs:
        spark.sql(spec.create_statement(f"{database}.{spec.name}", f"{location}/{spec.name}"))


def drop_tables(
    spark: SparkSession, specs: Iterable[TableSpec], database: str = "default"
) -> None:
    for spec in specs:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{spec.name}")


def load_table(df: DataFrame, table: str, mode: str = "append") -> None:
    """Insert ``df`` by position: ``append``, or ``overwrite`` to empty the table first."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown load mode {mode!r}")
    df.write.insertInto(table, overwrite=mode == "overwrite")


def overwrite_partition(df: DataFrame, table: str, partition: Mapping[str, str]) -> None:
    """Make ``df`` the content of the partitions of a table with the given values, whatever other
    columns it is partitioned by besides. Repeating it changes nothing."""
    spark = df.sparkSession
    fixed = ", ".join(f"`{c}` = '{v}'" for c, v in partition.items())
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    free = [c for c in parts if c not in partition]
    plain = [c for c in spark.table(table).columns if c not in parts]
    listed = ", ".join(f"`{c}`" for c in [*plain, *free])
    spec = ", ".join([fixed, *[f"`{c}`" for c in free]])
    spark.sql(f"INSERT OVERWRITE {table} PARTITION ({spec}) SELECT {listed} FROM {{rows}}", rows=df)


def insert_columns(df: DataFrame, table: str, columns: Sequence[str]) -> None:
    """Append to the listed columns of ``table``; the others become null."""
    listed = ", ".join(f"`{c}`" for c in columns)
    df.sparkSession.sql(
        f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {{rows}}", rows=df
    )


def conform(df: DataFrame, spec: TableSpec | T.StructType) -> DataFrame:
    """Bring ``df`` to the column order and the types of ``spec`` (null where a cast fails)."""
    schema = spec if isinstance(spec, T.StructType) else spec.schema
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def rejects(df: DataFrame, spec: TableSpec) -> DataFrame:
    """What ``conform`` would lose, counted in one pass: (table_name, column_name, rejected).

    A value is rejected if its cast fails, or if it is null where the contract wants one. Rows
    that repeat a key count under the key's columns, joined by commas.
    """
    counts = []
    for f in spec.schema.fields:
        bad = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        if f.name in spec.not_null:
            bad = bad | F.col(f.name).isNull()
        counts.append((f.name, F.count_if(bad)))
    if spec.key:
        key = F.struct(*[F.col(c).try_cast(spec.schema[c].dataType) for c in spec.key])
        counts.append((",".join(spec.key), F.count(F.lit(1)) - F.count_distinct(key)))
    row = df.agg(*[n.alias(f"__n{i}") for i, (_, n) in enumerate(counts)])
    entries = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"__n{i}").alias("rejected"))
        for i, (name, _) in enumerate(counts)
    ]
    return row.select(F.lit(spec.name).alias("table_name"), F.inline(F.array(*entries)))


def accept(df: DataFrame, spec: TableSpec, allowance: int = 0) -> DataFrame:
    """Conform rows to a contract; an error if more than ``allowance`` values of a column, or
    repeated keys, are rejected. Counting them is a pass of its own over ``df``."""
    failed = rejects(df, spec).where(F.col("rejected") > allowance).collect()
    if failed:
        listing = ", ".join(f"{r.column_name} ({r.rejected})" for r in failed)
        raise ValueError(f"{spec.name}: rejected values in {listing}")
    return conform(df, spec)


# -- keyed tables ----------------------------------------------------------------------------

#: The table of a dataset that holds nothing else.
ROWS = "rows"


def keyed_table(spark: SparkSession, path: str) -> Dataset:
    """The dataset of a keyed table. A folder that holds anything else is refused: taken for a new
    table, what is there would no longer be seen."""
    data = Dataset(spark, path)
    foreign = {*data.files.names(path)} - {ROWS, "_commits", "_ledger"}
    if foreign:
        raise ValueError(f"{path} is no keyed table: it holds {', '.join(sorted(foreign)[:3])}")
    return data


def versions(spark: SparkSession, path: str) -> list[int]:
    """The commits of the keyed table at ``path`` that can still be read, in order."""
    return keyed_table(spark, path).numbers()


def read_version(
    spark: SparkSession, path: str, schema: T.StructType, number: int | None = None
) -> DataFrame:
    """A keyed table as of its last commit or another; no rows if there is none."""
    data = keyed_table(spark, path)
    return data.read(ROWS, schema, data.commit(number))


def _merge_into(
    path: str,
    incoming: DataFrame,
    spec: TableSpec,
    merged: Callable[[DataFrame, DataFrame], DataFrame],
    buckets: int,
) -> None:
    """Rewrite the buckets of a keyed table that a batch touches, by one commit; the commit before
    stays for its readers."""
    data = keyed_table(incoming.sparkSession, path)
    with data.change() as change:
        change.merge(ROWS, incoming, spec, merged, buckets)
        change.publish()
    data.vacuum()


# -- keyed merges ----------------------------------------------------------------------------


def with_whole_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Refuse rows that have a null in their key, when they are read: a null equals no other,
    so such a row would be added again by every run."""
    refused = F.raise_error(F.lit(f"null in the key {', '.join(key)}"))
    return df.withColumns(
        {c: F.when(F.col(c).isNull(), refused).otherwise(F.col(c)) for c in key}
    )


def new_rows(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The rows insert-ignore adds: the first incoming row of each key not yet existing.

    Both sides of the anti join have at most one row per key, so no key is heavy. A null in an
    incoming key is an error.
    """
    arrived = first_per_key(with_whole_keys(incoming, key), key, order).select(*existing.columns)
    return arrived.join(existing.select(*key), list(key), "left_anti")


def in_touched_partitions(
    existing: DataFrame,
    incoming: DataFrame,
    partition_by: Sequence[str],
    key: Sequence[str],
    computed: Sequence[str] = (),
) -> DataFrame:
    """The existing rows that lie in partitions for which rows come in, by a semi join with the
    distinct partitions of the batch.

    A merge may look only there if the key fixes the partition. So each partition column must be
    one of the key, or be listed in ``computed`` as a value computed from the key.
    """
    loose = [c for c in partition_by if c not in {*key, *computed}]
    if loose:
        raise ValueError(f"the key {list(key)} does not fix the partition columns {loose}")
    touched = incoming.select(*[F.col(c).alias(f"__{c}") for c in partition_by]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in partition_by]
    return existing.join(touched, reduce(and_, same, F.lit(True)), "left_semi")


def insert_ignore(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Existing rows win over incoming ones, earlier incoming rows over later ones."""
    return existing.unionByName(new_rows(existing, incoming, key, order))


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    update: Sequence[str],
) -> DataFrame:
    """Insert new keys; for known keys overwrite only the ``update`` columns.

    Incoming rows count in ``order``: the first of a new key gives its other columns, the last
    of any key gives its ``update`` columns. They are reduced to one row per key map-side.
    A null in an incoming key is an error.
    """
    incoming = with_whole_keys(incoming, key)
    kept = [c for c in existing.columns if c not in {*key, *update}]
    turn = F.struct(*order, *[c for c in incoming.columns if c not in {*order, *key}])
    arrived = incoming.groupBy(*key).agg(F.min(turn).alias("__first"), F.max(turn).alias("__last"))
    known = existing.select(*key, F.struct(*kept, *update).alias("__old"))
    merged = known.join(arrived, list(key), "full_outer")
    is_known, has_arrived = F.col("__old").isNotNull(), F.col("__last").isNotNull()

    def column(name: str):
        if name in key:
            return F.col(name)
        if name in update:
            return F.when(has_arrived, F.col(f"__last.{name}")).otherwise(F.col(f"__old.{name}"))
        return F.when(is_known, F.col(f"__old.{name}")).otherwise(F.col(f"__first.{name}"))

    return merged.select(*[column(c).alias(c) for c in existing.columns])


def last_write_wins(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each write replaces the row of the same key."""
    return last_per_key(df, key, order)


def insert_ignore_into(
    path: str, incoming: DataFrame, key: Sequence[str], order: Sequence[str], spec: TableSpec
) -> None:
    """Insert-ignore into the table at ``path``. Only new rows are written, so a repeated run
    adds nothing."""
    existing = read_if_exists(incoming.sparkSession, path, spec.schema)
    append(conform(new_rows(existing, incoming, key, order), spec), path, spec.partition_by)


def upsert_into(
    path: str,
    incoming: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    update: Sequence[str],
    spec: TableSpec,
    buckets: int = 64,
) -> None:
    """Upsert into the keyed table at ``path``. Only buckets with keys of the batch are read and
    rewritten; a failure leaves the table as it was."""
    spec = replace(spec, key=tuple(key))

    def merged(existing: DataFrame, batch: DataFrame) -> DataFrame:
        return upsert(existing, batch, key, order, update)

    _merge_into(path, with_whole_keys(incoming, key), spec, merged, buckets)


def last_write_into(
    path: str,
    incoming: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    spec: TableSpec,
    buckets: int = 64,
) -> None:
    """Load incoming rows over the keyed table at ``path``: they replace rows of the same key. Only
    buckets with keys of the batch are read and rewritten; a failure leaves the table as it was."""
    spec = replace(spec, key=tuple(key))

    def merged(existing: DataFrame, batch: DataFrame) -> DataFrame:
        latest = last_write_wins(batch, key, order).select(*existing.columns)
        untouched = existing.join(latest.select(*key), list(key), "left_anti")
        return untouched.select(*existing.columns).unionByName(latest)

    _merge_into(path, with_whole_keys(incoming, key), spec, merged, buckets)


# -- layouts ---------------------------------------------------------------------------------


def clustered(
    df: DataFrame, partition_key: Sequence[str], clustering: Sequence[str] = ()
) -> DataFrame:
    """Order rows for lookups by partition key that return them in clustering order.

    Ranges are cut over both, so the rows of one huge partition key may span several files,
    each with a range of the clustering columns.
    """
    by = [*partition_key, *clustering]
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def bucket_sizes(df: DataFrame, buckets: int, key: Sequence[str]) -> DataFrame:
    """Rows per bucket, to see before bucketing whether a frequent key makes one too large."""
    bucket = F.pmod(F.hash(*key), F.lit(buckets)).alias("bucket")
    return df.groupBy(bucket).agg(F.count(F.lit(1)).alias("row_count"))


def save_bucketed(
    df: DataFrame,
    table: str,
    buckets: int,
    key: Sequence[str],
    path: str,
    sort: Sequence[str] = (),
) -> None:
    """A table bucketed by ``key``: two such tables join on it without a shuffle.

    A bucket is read by one task. ``bucket_sizes`` tells how even they will be; for a key that
    is too frequent use ``clustered``, whose joins shuffle and let the planner split it.
    """
    shuffled = df.hint("rebalance", buckets, *[F.col(c) for c in key])
    writer = shuffled.write.bucketBy(buckets, *key).sortBy(*(sort or key))
    writer.mode("overwrite").format("parquet").option("path", path).saveAsTable(table)
