"""Change feeds of keyed tables: rows (op, seq, key, columns)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.changelog import OP


def change_feed(rows: DataFrame, op: Column, sequence: Column) -> DataFrame:
    """Name the operation (I, U or D) and the position of each change."""
    return rows.withColumns({OP: op, "seq": sequence})


def initial_rows(table: DataFrame) -> DataFrame:
    """A table's present rows as inserts before every change."""
    return change_feed(table, F.lit("I"), F.lit(-1).cast("bigint"))
