"""Column expressions shared by the cleaning, star and gold jobs.

Everything here is a built-in Spark expression, so it stays inside code
generation and reaches the scan where the optimizer can push it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a hashed key, so NULL and '' differ.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

SECONDS_PER_DAY = 86400


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- types -----------------------------------------------------------------

def typed(c: str | Column, type_name: str) -> Column:
    """Cast that turns unreadable input into NULL instead of failing the job."""
    return col(c).try_cast(type_name)


def as_timestamp(c: str | Column) -> Column:
    return typed(c, "timestamp")


def money(c: str | Column) -> Column:
    return col(c).cast("decimal(10,2)")


# --- time ------------------------------------------------------------------

def calendar_days(start: str | Column, end: str | Column) -> Column:
    """Midnights crossed between the two instants."""
    return F.datediff(col(end), col(start))


def elapsed_days(start: str | Column, end: str | Column) -> Column:
    """Full 24-hour periods between the two instants, cut towards zero."""
    return F.timestamp_diff("DAY", col(start).cast("timestamp"), col(end).cast("timestamp"))


def whole_days_between_texts(start: str | Column, end: str | Column,
                             fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Full days between two formatted texts; negative spans round down."""
    def seconds_of(text: Column) -> Column:
        return F.unix_timestamp(F.try_to_timestamp(text, F.lit(fmt)))
    seconds = seconds_of(col(end)) - seconds_of(col(start))
    return F.floor(seconds / SECONDS_PER_DAY).cast("int")


def month_text(ts: str | Column) -> Column:
    return F.date_format(col(ts), "yyyy-MM")


def month_start(ts: str | Column) -> Column:
    return F.date_trunc("month", col(ts)).cast("date")


# --- flags and labels ------------------------------------------------------

def on_time(delivered: str | Column, estimated: str | Column) -> Column:
    """True, false, or NULL while either instant is unknown."""
    return col(delivered) <= col(estimated)


def late_flag(delivered: str | Column, estimated: str | Column) -> Column:
    """1 when delivered after the estimate, 0 otherwise and while undelivered."""
    return F.coalesce((col(delivered) > col(estimated)).cast("int"), F.lit(0))


def has_text(c: str | Column) -> Column:
    return F.coalesce(F.length(F.trim(col(c))) > 0, F.lit(False))


def place_name(c: str | Column) -> Column:
    return F.upper(F.trim(col(c)))


def first_known(*candidates: str | Column, default: str) -> Column:
    """First non-NULL candidate, else the default label."""
    return F.coalesce(*[col(c) for c in candidates], F.lit(default))


def sentiment(score: str | Column) -> Column:
    """positive from 4, neutral at 3, negative below; a missing score counts as negative."""
    s = col(score)
    return F.when(s >= 4, "positive").when(s == 3, "neutral").otherwise("negative")


def status_route(status: str | Column) -> Column:
    """Which desk handles an order in the given status."""
    s = col(status)
    # fixed values: the four desks and the statuses they take
    return (F.when(s == "delivered", "OK")
            .when(s == "canceled", "ALERT")
            .when(s.isin("shipped", "processing"), "INFO")
            .otherwise("UNKNOWN"))


def lookup(c: str | Column, mapping: Mapping[str, str], default: str) -> Column:
    """Small driver-side mapping applied as a map literal, with a default."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(c)), F.lit(default))


# --- numbers ---------------------------------------------------------------

def rows() -> Column:
    return F.count(F.lit(1))


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient; NULL where the denominator is zero."""
    quotient = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    return F.round(quotient, digits)


def percent(numerator: Column, denominator: Column, digits: int) -> Column:
    return ratio(numerator.cast("double") * 100, denominator, digits)


def amount(c: Column, digits: int = 2) -> Column:
    """Money for reports: exact decimal sums become doubles only at the very end."""
    return F.round(c.cast("double"), digits)


# --- keys and buckets ------------------------------------------------------

def surrogate_key(*columns: str | Column) -> Column:
    """Deterministic hashed key in which NULL parts stay distinguishable."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(NULL_KEY_PART)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def random_bucket(buckets: int, seed: int) -> Column:
    return F.floor(F.rand(seed) * buckets).cast("int")


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Stable bucket of a key, for tables that are rewritten bucket by bucket."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


# --- arrays and maps -------------------------------------------------------

def array_total(values: str | Column) -> Column:
    return F.aggregate(col(values), F.lit(0.0), lambda acc, v: acc + v)


def array_above(values: str | Column, threshold: float) -> Column:
    return F.filter(col(values), lambda v: v > threshold)


def array_descending(values: str | Column) -> Column:
    return F.sort_array(col(values), asc=False)


def map_above(counts: str | Column, threshold: int) -> Column:
    return F.map_filter(col(counts), lambda _, v: v > threshold)


def map_top(counts: str | Column, n: int) -> Column:
    """The n entries with the largest values; equal values order by key."""
    def larger_first(a: Column, b: Column) -> Column:
        return (F.when(a["value"] > b["value"], -1).when(a["value"] < b["value"], 1)
                .when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    return F.slice(F.array_sort(F.map_entries(col(counts)), larger_first), 1, n)
