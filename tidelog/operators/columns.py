"""Projection and column operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.session import configure


def add_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns; a name that is already there is an error."""
    taken = {c.lower() for c in df.columns}
    clash = sorted(name for name in columns if name.lower() in taken)
    if clash:
        raise ValueError(f"columns already present: {', '.join(clash)}")
    return df.withColumns(columns)


def add_or_replace_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.withColumns(columns)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; an unknown name is an error."""
    known = {c.lower() for c in df.columns}
    missing = sorted(name for name in names if name.lower() not in known)
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    return df.drop(*names)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def rename_all(df: DataFrame, *names: str) -> DataFrame:
    """Rename every column by position."""
    return df.toDF(*names)


def nested_field(struct: str, field: str, default: str | None = None) -> Column:
    """A field of a struct column, also one with `-` in its name.

    `default` stands in where the struct or the field is missing.
    """
    value = F.col(struct).getField(field)
    return value if default is None else F.coalesce(value, F.lit(default))


def flatten_field(df: DataFrame, struct: str, field: str, name: str, default: str = "") -> DataFrame:
    """Copy a nested field to the top level."""
    return df.withColumn(name, nested_field(struct, field, default))


def parse_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Decode a JSON text column and put its fields at the top level, beside the other columns."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, fields_of(F.from_json(column, schema)))


def fields_of(record: Column) -> Column:
    """The fields of a decoded record as columns of a `select`.

    As a generator the decoding runs once per row. Plain field access would repeat it in
    every filter on a field, since Spark moves such filters below the decoding.
    """
    return F.inline(F.array(record))


def select_all_sql(df: DataFrame) -> DataFrame:
    return df.sparkSession.sql("SELECT * FROM {rows}", rows=df)


def temporary_view(df: DataFrame, name: str, replace: bool = True) -> DataFrame:
    """Register `df` under `name` and return the view as a frame."""
    if replace:
        df.createOrReplaceTempView(name)
    else:
        df.createTempView(name)
    return df.sparkSession.table(name)


def drop_view(spark, name: str) -> bool:
    """Drop a view if it is there; tells whether it was."""
    return spark.catalog.dropTempView(name)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text `explain` prints."""
    configure(df.sparkSession)
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )
