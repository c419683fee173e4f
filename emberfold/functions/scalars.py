"""Column functions for cleaning: casts that never raise, text, dates, keys."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- casts and predicates -------------------------------------------------


def castable(c: Column, kind: str) -> Column:
    """True where the text can be read as ``kind``; NULL counts as not castable."""
    return c.try_cast(kind).isNotNull()


def whole_number(column: str) -> Column:
    """Integer of a text like ``12`` or ``12.0``; the fraction is cut, junk is NULL."""
    return F.expr(
        f"COALESCE(TRY_CAST(`{column}` AS INT), TRY_CAST("
        f"regexp_extract(`{column}`, '^[ ]*([+-]?[0-9]+)[.][0-9]*[ ]*$', 1) AS INT))")


def castable_or_null(c: Column, kind: str) -> Column:
    return castable(c, kind) | c.isNull()


def any_present(*columns: Column) -> Column:
    return reduce(lambda a, b: a | b, [c.isNotNull() for c in columns])


def dated_or_counted(parts: list[Column], count: Column) -> Column:
    """False where a date part is missing and the count is missing as well."""
    return ~(reduce(lambda a, b: a | b, [p.isNull() for p in parts]) & count.isNull())


# --- text -----------------------------------------------------------------


def clean_token(c: Column, token: str = "Nan") -> Column:
    """Replace a literal token by a blank, then trim."""
    return F.trim(F.replace(c, F.lit(token), F.lit(" ")))


def pair_part(c: Column, index: int, kind: str = "double") -> Column:
    """One number of a ``"lat, lon"`` text; NULL if it is missing or not a number."""
    return F.trim(F.get(F.split(c, r",\s*"), index)).try_cast(kind)


def decode(column: str, labels: Mapping[int, str]) -> Column:
    """Label of a code; a code without a label passes through as text.

    A look into a map and not a CASE per label, of which a few make a generated method too long for the JVM to compile.
    """
    listed = F.create_map(*[F.lit(v) for pair in labels.items() for v in pair])
    return F.coalesce(F.try_element_at(listed, F.col(column)), F.col(column).cast("string"))


def binary_flag(c: Column, positive: str) -> Column:
    """1 where the trimmed lower-case text equals ``positive``, else 0 (also for NULL)."""
    return F.coalesce((F.lower(F.trim(c)) == F.lit(positive)).cast("int"), F.lit(0))


def threshold_label(p: Column, above: str, below: str, threshold: float = 0.5) -> Column:
    """Text decision from a probability; NULL stays NULL."""
    return F.when(p > threshold, F.lit(above)).when(p <= threshold, F.lit(below))


# --- dates ----------------------------------------------------------------


def timestamp_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts),
        "hour": F.hour(ts), "minute": F.minute(ts),
    }


def iso_weekday(d: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(d) + 1


def sunday_first_weekday(d: Column) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(d)


# --- keys -----------------------------------------------------------------

UNKNOWN_KEY = -1


def date_key(day: Column, month: Column, year: Column) -> Column:
    """Date as the number DDMMYYYY; NULL if a part is missing."""
    return (day * 1_000_000 + month * 10_000 + year).cast("int")


def sortable_date_key(day: Column, month: Column, year: Column) -> Column:
    """Date as the number YYYYMMDD; NULL if a part is missing."""
    return (year * 10_000 + month * 100 + day).cast("int")


def surrogate_key(*columns: Column, narrow: bool = False) -> Column:
    """Hash key of a natural key.

    The default is 64 bits wide and maps an all-NULL natural key to -1.
    ``narrow`` gives the 31-bit form (absolute Murmur3 hash, NULL hashes to
    42), which meets its first collisions at some 50,000 keys.
    """
    if narrow:
        return F.abs(F.hash(*columns).cast("bigint"))
    return F.when(any_present(*columns), F.xxhash64(*columns)).otherwise(
        F.lit(UNKNOWN_KEY).cast("bigint"))


def row_digest(*columns: Column) -> Column:
    """128-bit text id from the given columns, the same on every run and layout.

    Each part is prefixed with its length, so ("ab", "c") and ("a", "bc") differ.
    """
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text),
                                F.lit("-")))
    return F.md5(F.concat_ws("|", *parts))
