"""Contracts that are counted by the pass that writes: broken records, failed casts, missing and
long values."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starmill.schemas import TableSpec
from starmill.session import stage

#: The column in which a scan puts the text of a record that it cannot parse.
BROKEN = "__broken"
#: Records that a refusal quotes, and how much of each.
QUOTED, QUOTED_CHARS = 5, 200


class Refused(ValueError):
    """A load lost more rows than it may."""


def faults(spec: TableSpec, columns: Sequence[str] = ()) -> dict[tuple[str, str], Column]:
    """What can be wrong with a row, by (check, column). A cast that fails counts as such only,
    not as a missing value too; a record that could not be parsed only as broken, if ``columns``
    of the rows have one for such records."""
    whole, out = F.lit(True), {}
    if BROKEN in columns:
        whole = F.col(BROKEN).isNull()
        out["broken", ""] = ~whole
    for f in spec.schema.fields:
        value = F.col(f.name)
        typed = value.try_cast(f.dataType)
        out["cast", f.name] = whole & value.isNotNull() & typed.isNull()
        if f.name in spec.not_null:
            out["not_null", f.name] = whole & value.isNull()
        if f.name in spec.max_length:
            too_long = F.char_length(typed.cast("string")) > spec.max_length[f.name]
            out["max_length", f.name] = whole & F.coalesce(too_long, F.lit(False))
    return out


def conformed(spec: TableSpec) -> list[Column]:
    return [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in spec.schema.fields]


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


class Load:
    """Rows on their way into a table. ``rows`` are those that keep the contract, in its types,
    after the columns ``extra``; once they have been written, ``counts`` tells what was left out.

    Counting is part of the write, by an observation, so it takes no pass of its own. If tasks
    whose output was lost ran again, an observation may count their rows twice. So nothing is
    refused on its word alone: ``recount`` reads the input again before that.
    """

    def __init__(self, df: DataFrame, spec: TableSpec, extra: Sequence[str] = ()):
        self.spec, self.source = spec, df
        self.faults = faults(spec, df.columns)
        self.observation = Observation(f"load-{spec.name}-{uuid.uuid4().hex}")
        # A filter over all columns, below a cast of each, would have the optimizer derive filters
        # from it for every choice of cast columns. So rows are left out by a generator.
        good = F.when(~any_of(self.faults.values()), F.array(F.struct(*conformed(spec))))
        observed = df.observe(self.observation, *self._measures())
        self.rows = observed.select(*extra, F.inline(good))

    def _measures(self) -> list[Column]:
        found = [F.count_if(bad).alias(f"f{i}") for i, bad in enumerate(self.faults.values())]
        lost = F.count_if(any_of(self.faults.values())).alias("lost")
        return [F.count(F.lit(1)).alias("read"), lost, *found]

    def _named(self, values: dict[str, int]) -> list[tuple[str, str, str, int]]:
        name = self.spec.name
        totals = [(name, n, "", values.get(n, 0)) for n in ("read", "lost")]
        return totals + [
            (name, check, column, values.get(f"f{i}", 0))
            for i, (check, column) in enumerate(self.faults)
        ]

    def counts(self) -> list[tuple[str, str, str, int]]:
        """(table, check, column, rows): rows read and lost, then rows at fault by check."""
        try:
            return self._named(dict(self.observation.get))
        except Py4JJavaError:  # nothing observed: the plan was seen to have no rows, and cut down
            return self.recount()

    def recount(self) -> list[tuple[str, str, str, int]]:
        return self._named(self.source.agg(*self._measures()).first().asDict())

    def lost(self) -> int:
        return self.counts()[1][3]

    def rejects(self) -> DataFrame:
        return reject_rows(self.source, self.spec)


def refuse(loads: Iterable[tuple[Load, int]]) -> None:
    """Raise ``Refused`` if a table lost more rows than its allowance, with every fault of every
    such table and the first of the records."""
    listings, quoted = [], []
    for load, allowance in loads:
        if load.lost() <= allowance:
            continue
        (name, _, _, read), (*_, lost), *found = load.recount()
        if lost > allowance:
            listings += [
                f"{name}: {f'{check} {column}'.strip()} ({n} of {read} rows)"
                for _, check, column, n in found
                if n
            ]
            quoted += [
                f"{r.file or name}: {'; '.join(r.reasons)}: {r.record[:QUOTED_CHARS]}"
                for r in load.rejects().limit(QUOTED).collect()
            ]
    if listings:
        raise Refused("\n  ".join(["load refused: " + "; ".join(listings), *quoted]))


def reject_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows a load would leave out: (table_name, file, reasons, record). Reasons are "check
    column" in the order of the contract; the record is the text that could not be parsed, or the
    row as JSON. ``file`` is null if the rows do not tell where they are from."""
    found = faults(spec, df.columns)
    reasons = F.array_compact(
        F.array(*[F.when(bad, F.lit(f"{c} {n}".strip())) for (c, n), bad in found.items()])
    )
    record = F.to_json(F.struct(*[F.col(f.name) for f in spec.schema.fields]))
    if BROKEN in df.columns:
        record = F.coalesce(F.col(BROKEN), record)
    file = F.col("file") if "file" in df.columns else F.lit(None).cast("string")
    return (
        df.withColumn("__reasons", reasons)
        .where(F.size("__reasons") > 0)
        .select(
            F.lit(spec.name).alias("table_name"),
            file.alias("file"),
            F.col("__reasons").alias("reasons"),
            record.alias("record"),
        )
    )


def admit(
    df: DataFrame,
    spec: TableSpec,
    extra: Sequence[str] = (),
    allowance: int = 0,
    rejects_to: str | None = None,
) -> DataFrame:
    """Stage raw rows under a contract: parsed, counted and written in one pass. Beyond the
    allowance the load is refused; within it, the rows left out are appended to the JSON lines at
    ``rejects_to``, by a second pass that runs only if there are any."""
    load = Load(df, spec, extra)
    staged = stage(load.rows, spec.name)
    refuse([(load, allowance)])
    if rejects_to is not None and load.lost():
        load.rejects().write.mode("append").json(rejects_to)
    return staged
