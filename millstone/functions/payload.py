"""Semi-structured payload helpers (JSON text column).

The payload is parsed once per row with ``from_json`` against a fixed read
schema that lists only the keys the pipeline uses; Jackson skips the rest,
so parsing cost does not grow with unused keys.  Presence tests and key
counts are separate, cheaper probes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def parse(payload, schema: StructType) -> Column:
    """NULL-tolerant parse: malformed text gives a struct of NULLs."""
    return F.from_json(_c(payload), schema, {"mode": "PERMISSIVE"})


def json_int(x) -> Column:
    """JSON number or numeric text -> BIGINT, rounding half away from zero
    (4.6 -> 5); exact over the whole 64-bit range, NULL beyond it."""
    return F.round(_c(x).try_cast("decimal(38,6)"), 0).try_cast("long")


def json_double(x) -> Column:
    """JSON number or numeric text -> DOUBLE; anything else NULL."""
    return _c(x).try_cast("double")


def is_object(payload) -> Column:
    """Whether the text is a well-formed JSON object."""
    return F.json_object_keys(_c(payload)).isNotNull()


def key_present(payload, key: str) -> Column:
    """True when the text is an object with this top-level key, even with a
    JSON ``null`` value (an explicit null counts as present)."""
    return F.coalesce(F.array_contains(F.json_object_keys(_c(payload)), key), F.lit(False))


def key_count(payload) -> Column:
    """Number of top-level keys; NULL for malformed or non-object text."""
    return F.size(F.json_object_keys(_c(payload)))


def text_flag(x) -> Column:
    """0/1 numbers or true/false text -> BOOLEAN; anything else NULL."""
    v = _c(x)
    return F.coalesce(v.try_cast("int") != 0, v.try_cast("boolean"))


def text_int(x) -> Column:
    """Number or numeric text -> INT; 'F1' -> NULL."""
    return _c(x).try_cast("int")
