"""Strict readers for JSON held in VARIANT columns.

Every function takes a VARIANT column and returns a typed column.  The rule
common to all of them: a value of another JSON type counts as absent, nothing
is coerced.  Spark's own casts from VARIANT do coerce (``true`` to 1, ``"5"``
to 5, ``5`` to ``'5'``), so each reader looks at the JSON type first.

SQL NULL stands for a missing key.  An explicit JSON ``null`` is a VARIANT
that is not SQL NULL, which is what ``present`` and ``compact`` rely on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type names that schema_of_variant() reports for JSON scalars.
STRING = "STRING"
INTEGER = "BIGINT"
BOOLEAN = "BOOLEAN"
DOUBLE = "DOUBLE"
DECIMAL = "DECIMAL"
MIXED = "VARIANT"


def at(v: Column, path: str) -> Column:
    """The value below ``path`` (``a`` or ``a.b``); NULL where a step is missing."""
    return F.variant_get(v, f"$.{path}", "variant")


def element(v: Column, place: int) -> Column:
    """An element of an array; NULL where there is none."""
    return F.try_variant_get(v, f"$[{place}]", "variant")


def present(v: Column) -> Column:
    """True if the key exists, even with the value ``null``."""
    return v.isNotNull()


def itself(v: Column) -> Column:
    return v


def text(v: Column) -> Column:
    """A JSON string."""
    return F.when(F.schema_of_variant(v) == STRING, F.variant_get(v, "$", "string"))


def whole(v: Column) -> Column:
    """A JSON integer literal in 64-bit range; ``5.0`` and ``5e0`` are not integers."""
    return F.when(F.schema_of_variant(v) == INTEGER, F.variant_get(v, "$", "bigint"))


def number(v: Column) -> Column:
    """Any JSON number as a double."""
    kind = F.schema_of_variant(v)
    numeric = kind.isin(INTEGER, DOUBLE) | kind.startswith(DECIMAL)
    return F.when(numeric, F.try_variant_get(v, "$", "double"))


def truth(v: Column) -> Column:
    """``true`` or ``false``."""
    return F.when(F.schema_of_variant(v) == BOOLEAN, F.variant_get(v, "$", "boolean"))


def fractional(v: Column) -> Column:
    """Whether a number in the value may be no 64-bit integer; so may one among other types."""
    return F.schema_of_variant(v).rlike(f"{DECIMAL}|{DOUBLE}|{MIXED}")


def items(v: Column) -> Column:
    """The elements of a JSON array; NULL for anything else."""
    return F.try_variant_get(v, "$", "array<variant>")


def fields(v: Column, keys: Iterable[str]) -> Column:
    """The values of these keys of a JSON object, side by side; NULL for anything else."""
    return F.try_variant_get(v, "$", f"struct<{', '.join(f'`{key}`: variant' for key in keys)}>")


def texts(v: Column) -> Column:
    """The elements of a JSON array as strings, with NULL for those that are none."""
    return F.transform(items(v), text)


# ---- on columns that are read already


def compact(v: Column) -> Column:
    """Any JSON value as compact text with sorted keys.

    A missing key is NULL, an explicit null is the four characters ``null``.
    """
    return F.to_json(v)


def wrapped(n: Column) -> Column:
    """A 64-bit integer cut to its low 32 bits: overflow wraps instead of failing."""
    return F.shiftright(F.shiftleft(n, 32), 32).cast("int")


def joined(texts: Column, separator: str = "; ") -> Column:
    """Strings as one, without the NULLs; an empty array gives the empty string."""
    return F.array_join(texts, separator)


def first(values: Column) -> Column:
    """The first element that is not NULL."""
    return F.get(F.array_compact(values), F.lit(0))


def once(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that it uses several times, and that is computed once.

    Spark may compute a part that occurs several times in advance, for all rows, even
    where it stands below a condition that few rows meet; below another function of
    arrays it computes it every time.
    """
    return F.get(F.transform(F.array(value), fn), F.lit(0))
