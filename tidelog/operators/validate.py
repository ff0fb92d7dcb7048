"""Type checks on JSON records that arrive as text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


@dataclass(frozen=True)
class FieldRule:
    """One required field: its JSON path and the JSON types it may have."""

    path: str
    types: tuple[str, ...]
    name: str


# Booleans count as whole numbers here, as they do in the checked records' home language.
TEXT = ("STRING",)
WHOLE_NUMBER = ("BIGINT", "BOOLEAN")
OBJECT = ("OBJECT",)

EDGE_LOG_RULES = (
    FieldRule("$", OBJECT, "record"),
    FieldRule("$.EdgeEndTimestamp", TEXT, "EdgeEndTimestamp"),
    FieldRule("$.ClientRequestURI", TEXT, "ClientRequestURI"),
    FieldRule("$.EdgeResponseStatus", WHOLE_NUMBER, "EdgeResponseStatus"),
    FieldRule("$.ResponseHeaders", OBJECT, "ResponseHeaders"),
    FieldRule('$.ResponseHeaders["x-org-uid"]', TEXT, "x-org-uid"),
)


def _json_type(parsed: Column, path: str) -> Column:
    """STRING, BIGINT, BOOLEAN, OBJECT<...>, ...; NULL when the path is not there."""
    return F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))


def _satisfies(parsed: Column, rule: FieldRule) -> Column:
    found = F.regexp_extract(_json_type(parsed, rule.path), "^[A-Z]+", 0)
    return F.coalesce(found.isin(*rule.types), F.lit(False))


def check_records(
    df: DataFrame, column: str = "value", rules: tuple[FieldRule, ...] = EDGE_LOG_RULES
) -> DataFrame:
    """Add `reject_reason`: the first field that breaks its rule, or NULL for a good record."""

    def first_broken(parsed: Column) -> Column:
        return F.coalesce(*[F.when(~_satisfies(parsed, rule), F.lit(rule.name)) for rule in rules])

    # Bound as the element of an array, the text is parsed once however many rules there
    # are, also where a filter on the reason is pushed down.
    reasons = F.transform(F.array(F.try_parse_json(F.col(column))), first_broken)
    return df.withColumn(REASON, F.element_at(reasons, 1))


def split_records(
    df: DataFrame, column: str = "value", rules: tuple[FieldRule, ...] = EDGE_LOG_RULES
) -> tuple[DataFrame, DataFrame]:
    """(good records, rejected records with their reason)."""
    checked = check_records(df, column, rules)
    return checked.filter(F.col(REASON).isNull()).drop(REASON), checked.filter(F.col(REASON).isNotNull())


def reject_counts(
    df: DataFrame, column: str = "value", rules: tuple[FieldRule, ...] = EDGE_LOG_RULES
) -> DataFrame:
    """How many records each reason stopped; good records are counted under `ok`."""
    return (
        check_records(df, column, rules)
        .groupBy(F.coalesce(REASON, F.lit("ok")).alias("reason"))
        .agg(F.count("*").alias("records"))
    )
