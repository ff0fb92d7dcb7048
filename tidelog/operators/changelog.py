"""Change rows of running aggregates, and change feeds of keyed tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.ordered import HOT_KEY_ROWS, Aggregates, running

OP = "op"
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"


def aggregate_changelog(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggregates: Aggregates,
    max_rows_per_task: int = HOT_KEY_ROWS,
) -> DataFrame:
    """The changes a grouped aggregate goes through as its rows come in, in `order`.

    A key's first row gives `+I`; each later one `-U` with the old values and `+U` with
    the new ones. A row that changes no value gives nothing.
    """
    seen = running(
        df,
        keys,
        order,
        {**aggregates, "_rows": ("count", F.lit(1))},
        previous=True,
        max_rows_per_task=max_rows_per_task,
    )
    position = [F.col(c) for c in order]
    return seen.select(
        *[c for c in keys if c not in order], *position, F.inline(change_rows(list(aggregates)))
    )


def change_rows(names: Sequence[str]) -> Column:
    """Array of change rows from `<name>`, `previous_<name>` and the row counts beside them."""

    def change(op: str, prefix: str) -> Column:
        return F.struct(F.lit(op).alias(OP), *[F.col(prefix + n).alias(n) for n in names])

    same = reduce(
        lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"previous_{n}")) for n in names], F.lit(True)
    )
    return F.when(F.col("_rows") == 1, F.array(change(INSERT, ""))).when(
        ~same, F.array(change(UPDATE_BEFORE, "previous_"), change(UPDATE_AFTER, ""))
    )


def insert_changes(df: DataFrame) -> DataFrame:
    """Mark the rows of an append-only frame as inserts."""
    return df.withColumn(OP, F.lit(INSERT))


def keep_upserts(changes: DataFrame) -> DataFrame:
    """Only inserts and new values."""
    return changes.filter(F.col(OP).isin(INSERT, UPDATE_AFTER))


def apply_changes(
    feed: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    op: str = OP,
    deletes: Sequence[str] = ("D", DELETE),
) -> DataFrame:
    """The table a keyed change feed leads to: the newest change per key, unless it deletes.

    Withdrawn values (`-U`) are left out, since the new value beside them has the same place in
    the sequence. A NULL op is a change like any other.
    """
    rest = [c for c in feed.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*sequence)).alias("_newest")
    changes = feed.filter(~F.col(op).eqNullSafe(UPDATE_BEFORE))
    table = changes.groupBy(*keys).agg(newest).select(*keys, "_newest.*")
    return table.filter(~F.coalesce(F.col(op).isin(*deletes), F.lit(False))).drop(op)


def change_documents(changes: DataFrame, columns: Sequence[str], op: str = OP) -> DataFrame:
    """Each change as a JSON document `{"data": [row], "type": "INSERT" | "DELETE"}` in `value`.

    New values are inserts and withdrawn ones deletes, so replaying the documents in
    order gives the table.
    """
    kind = F.when(F.col(op).isin(INSERT, UPDATE_AFTER), "INSERT").otherwise("DELETE")
    document = F.struct(F.array(F.struct(*columns)).alias("data"), kind.alias("type"))
    return changes.select(F.to_json(document).alias("value"))
