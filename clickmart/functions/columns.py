"""Column expressions (all JVM-side built-ins, so they stay inside codegen)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Page paths of the shop and the event labels of the events mart.
PRODUCT_LIKE = "/product_%"          # '_' is a LIKE wildcard: '/products' matches too
CONFIRMATION_PATH = "/confirmation"
EVENT_LABELS = (
    ("/home", "go home"),
    ("/payment", "payment cart"),
    ("/cart", "go cart"),
    ("/confirmation", "confirmation payment"),
)
PRODUCT_LABEL = "add product"
ALL_EVENT_LABELS = (PRODUCT_LABEL, "go home", "payment cart", "go cart", "confirmation payment")

EPOCH = "1970-01-01 00:00:00"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_product(path: Column | str) -> Column:
    """``path LIKE '/product_%'``. The redundant prefix test is implied by the
    LIKE pattern; it lets a parquet scan push ``StringStartsWith`` down."""
    p = _c(path)
    return p.startswith("/product") & p.like(PRODUCT_LIKE)


def is_confirmation(path: Column | str) -> Column:
    return _c(path) == CONFIRMATION_PATH


def event_label(path: Column | str) -> Column:
    """CASE without ELSE: unknown paths give NULL (kept as a mart group)."""
    p = _c(path)
    out = F.when(p.like(PRODUCT_LIKE), F.lit(PRODUCT_LABEL))
    for value, label in EVENT_LABELS:
        out = out.when(p == value, F.lit(label))
    return out


def product_name(path: Column | str) -> Column:
    """Text after the first '_' (whole path when there is none)."""
    p = _c(path)
    return F.substr(p, F.instr(p, "_") + 1)


def hour_start(ts: Column | str) -> Column:
    """Hour truncation of a TIMESTAMP_NTZ, independent of the session time zone."""
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.lit(0), F.lit(0))


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ (time-zone free)."""
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), _c(ts))


def normalise_uuid(c: Column | str) -> Column:
    return F.lower(F.trim(_c(c)))


def isin_nullsafe(c: Column | str, values: Iterable) -> Column:
    """Membership that, like pandas ``isin``, matches NULL when None is selected."""
    vals = list(values)
    non_null = [v for v in vals if v is not None]
    col = _c(c)
    cond = col.isin(non_null) if non_null else F.lit(False)
    if len(non_null) != len(vals):
        cond = cond | col.isNull()
    return cond
