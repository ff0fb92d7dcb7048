"""Scalar functions, all as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's str.split() treats as blank.
WHITESPACE = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"

# The forms of ISO-8601 dates, times of day and zones that are accepted.
_DATE = r"(\d{4}-\d{2}-\d{2}|\d{8})"
_TIME = r"(\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{4}(?:\d{2}(?:[.,]\d+)?)?)"
_ZONE = r"(Z|[+-]\d{2}(?::?\d{2})?)"
ISO_DATE_TIME = f"^{_DATE}(?:[T ]{_TIME}{_ZONE}?)?$"
# the extended form with seconds, which most logs write
USUAL_DATE_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})?$"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def json_value(column: Column | str, path: str) -> Column:
    """The scalar at a JSON path as text; NULL for a missing path, an object, an array or bad JSON.

    What follows a complete object is not looked at.
    """
    column = _column(column)
    text = F.get_json_object(column, path)
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(column), path, "variant"))
    # Only a text that looks like an object or an array needs its type looked up.
    return F.when(~text.rlike(r"^[\[{]"), text).when(kind == "STRING", text)


def with_json_field(column: Column | str, schema: str, field: str, change) -> Column:
    """JSON text with one top-level field replaced by `change(old value)`, the rest kept."""
    parsed = F.from_json(_column(column), schema)
    return F.when(parsed.isNotNull(), F.to_json(parsed.withField(field, change(parsed[field]))))


def abs_mod(column: Column | str, n: int) -> Column:
    """abs(x) % n, also for the smallest long."""
    return F.abs(_column(column) % n)


def words(column: Column | str) -> Column:
    """The whitespace-separated words of a text."""
    return F.filter(F.split(_column(column), WHITESPACE), lambda word: word != "")


def message(column: Column | str) -> Column:
    return F.concat(F.lit("Message: "), _column(column))


def _iso_day(column: Column) -> Column:
    digits = F.translate(F.regexp_extract(column, ISO_DATE_TIME, 1), "-", "")
    return F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))


def iso_timestamp(column: Column | str, millis: bool = True) -> Column:
    """ISO-8601 text to a point in time. `Z` and no zone mean UTC; bad text gives NULL.

    Extended and compact forms are read, with hours alone or more, and fractions of any
    length, which are cut to microseconds. The session time zone must be UTC. With `millis`
    the time is cut to milliseconds.
    """
    column = _column(column)
    # the usual form is one that Spark reads itself; only what is left is taken apart
    usual = F.when(column.rlike(USUAL_DATE_TIME), F.try_to_timestamp(column)).otherwise(_parsed(column))
    return F.date_trunc("MILLISECOND", usual) if millis else usual


def _parsed(column: Column) -> Column:
    time = F.regexp_extract(column, ISO_DATE_TIME, 2)
    digits = F.translate(F.regexp_extract(time, r"^[\d:]+", 0), ":", "")
    whole = F.rpad(digits, 6, "0")
    clock = F.concat_ws(":", F.substring(whole, 1, 2), F.substring(whole, 3, 2), F.substring(whole, 5, 2))
    fraction = F.rpad(F.substring(F.regexp_extract(time, r"[.,](\d+)$", 1), 1, 6), 6, "0")
    zone = F.regexp_replace(F.regexp_extract(column, ISO_DATE_TIME, 3), r"^([+-]\d{2}):?(\d{2})?$", "$1:$2")
    zone = F.when(zone.endswith(":"), F.concat(zone, F.lit("00"))).otherwise(zone)
    text = F.concat(_iso_day(column), F.lit(" "), clock, F.lit("."), fraction, zone)
    return F.when(column.rlike(ISO_DATE_TIME), F.try_to_timestamp(text))


def iso_date(column: Column | str) -> Column:
    """The calendar date written in an ISO-8601 text, in the text's own zone; bad text gives NULL."""
    column = _column(column)
    day = F.when(column.rlike(USUAL_DATE_TIME), F.substring(column, 1, 10)).otherwise(_iso_day(column))
    return F.when(iso_timestamp(column, millis=False).isNotNull(), day)


def utc_millis(column: Column | str, pattern: str = "yyyy-MM-dd'T'HH:mm:ss'Z'") -> Column:
    """A date-time text in one fixed pattern, read as UTC, to epoch milliseconds."""
    return F.unix_millis(F.to_timestamp(_column(column), pattern))


def event_time_from_millis(column: Column | str) -> Column:
    return F.timestamp_millis(_column(column))


def safe_name(column: Column | str) -> Column:
    return F.translate(_column(column), "/?&", "___")


def document_id(org: Column | str, date: Column | str, name: Column | str) -> Column:
    """`org_date_name` with `/`, `?` and `&` of the name replaced by `_`."""
    return F.concat_ws("_", _column(org), _column(date), safe_name(name))


def window_document_id(org: Column | str, start: Column | str, name: Column | str) -> Column:
    """`document_id` for a window start: blanks become `_` and colons `-`."""
    return document_id(org, F.translate(_column(start).cast("string"), " :", "_-"), name)


def sha256(column: Column | str) -> Column:
    return F.sha2(_column(column).cast("string"), 256)


def row_id() -> Column:
    """A random id per row; differs when a task runs again."""
    return F.expr("uuid()")


def chunk_id(source: Column | str, chunk_no: Column | str) -> Column:
    """An id that stays the same when the job runs again."""
    return F.sha2(F.concat_ws("#", _column(source), _column(chunk_no).cast("string")), 256)


def lookup(index: Column | str, values: Sequence[str]) -> Column:
    """The entry of a constant list at a zero-based index; NULL outside it."""
    index = _column(index)
    entry = F.try_element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))
    return F.when(index >= 0, entry)


def collapse_blank_lines(column: Column | str) -> Column:
    """Each run of two or more line ends becomes one."""
    return F.regexp_replace(_column(column), r"\n{2,}", "\n")


# What is cut out of a page, in this order.
PAGE_CUTS = (
    (r"(?is)<!--.*?-->", ""),
    (r"(?is)<(script|style)[^>]*>.*?</(script|style)>", ""),
    (r"(?i)<(/p|/h[1-6]|/li|/div|br/?)>", "\n"),
    (r"<[^>]*>", ""),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", '"'),
    (r"&amp;", "&"),
)


def page_text(html: Column | str) -> Column:
    """The readable text of an HTML page, with runs of line ends collapsed."""
    text = _column(html)
    for pattern, replacement in PAGE_CUTS:
        text = F.regexp_replace(text, pattern, replacement)
    return collapse_blank_lines(text)

