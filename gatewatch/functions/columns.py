"""Scalar column expressions (all built-in, so they stay inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wheel code -> vehicle class; anything else (and NULL) is "Unknown".
WHEEL_CLASSES = (
    ("VWHEL0001", "C1"),
    ("VWHEL0002", "C2"),
    ("VWHEL0003", "C3"),
)
UNKNOWN_CLASS = "Unknown"

# Escape character handed to LIKE. The source database's LIKE has no escape
# character; Spark's default is a backslash. A control character that never
# occurs in province names makes every pattern character literal or wildcard.
NO_ESCAPE = "\u0001"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vehicle_class(wheel_code: Column | str = "vehicle_wheel_code") -> Column:
    """Searched CASE over the wheel code (FN1)."""
    code = _c(wheel_code)
    expr = None
    for value, cls in WHEEL_CLASSES:
        expr = F.when(code == value, cls) if expr is None else expr.when(code == value, cls)
    return expr.otherwise(UNKNOWN_CLASS)


def vehicle_class_code(wheel_code: Column | str = "vehicle_wheel_code") -> Column:
    """FN1 as a small integer: the 1-based position of the wheel code in
    ``WHEEL_CLASSES``, 0 for any other code or NULL. Evaluated before an
    aggregation it keeps the aggregation buffer fixed-width (hash aggregation
    instead of a sort-based one); ``vehicle_class_name`` turns it back."""
    code = _c(wheel_code)
    expr = None
    for i, (value, _) in enumerate(WHEEL_CLASSES, start=1):
        expr = F.when(code == value, i) if expr is None else expr.when(code == value, i)
    return expr.otherwise(0)


def vehicle_class_name(class_code: Column | str = "vehicle_class_code") -> Column:
    """The vehicle class of a ``vehicle_class_code``."""
    code = _c(class_code)
    expr = None
    for i, (_, cls) in enumerate(WHEEL_CLASSES, start=1):
        expr = F.when(code == i, cls) if expr is None else expr.when(code == i, cls)
    return expr.otherwise(UNKNOWN_CLASS)


def text_or_empty(c: Column | str) -> Column:
    """NULL -> '' (the source database treats '' as NULL in concatenation)."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def joined_text(*parts: Column | str, sep: str = " ") -> Column:
    """``a || sep || b`` with NULL parts as empty text (FN2).

    Unlike ``concat_ws`` the separator is kept when a part is NULL, so
    (NULL, 'X') gives ' X' as in the source database.
    """
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(text_or_empty(p))
    return F.concat(*pieces)


def plate_text(l1: Column | str = "vehicle_license_1", l2: Column | str = "vehicle_license_2") -> Column:
    return joined_text(l1, l2)


def like_column(value: Column | str, pattern: Column | str) -> Column:
    """``value LIKE pattern`` where the pattern is a column (FN3): ``%``/``_`` active,
    case-sensitive, no escape character."""
    return F.like(_c(value), _c(pattern), F.lit(NO_ESCAPE))


def url_or_empty(path: Column | str, prefix: str) -> Column:
    """``prefix + path + '?key='`` when the path is non-empty, else '' (FN9)."""
    p = text_or_empty(path)
    return F.when(p != "", F.concat(F.lit(prefix), p, F.lit("?key="))).otherwise(F.lit(""))


def safe_ratio(numerator: float, denominator: Column | str) -> Column:
    """``numerator / denominator`` as double, NULL for a zero or NULL denominator (FN11)."""
    return F.lit(float(numerator)) / F.nullif(_c(denominator).cast("double"), F.lit(0.0))


def timestamp_text(ts: Column | str) -> Column:
    """Timestamp as ``YYYY-MM-DD HH:MM:SS`` (``.ffffff`` appended when the
    fraction is non-zero), the way a Python timestamp prints (FN7)."""
    t = _c(ts).cast("string")  # no zone is involved for a TIMESTAMP_NTZ
    fraction = F.substring_index(t, ".", -1)
    return F.when(F.contains(t, F.lit(".")), F.concat(F.substring(t, 1, 20), F.rpad(fraction, 6, "0"))).otherwise(t)


def display_length(c: Column | str, null_text: str = "None") -> Column:
    """Characters in the printed value, NULL printing as ``null_text`` (FN12)."""
    return F.length(F.coalesce(_c(c).cast("string"), F.lit(null_text)))
