"""The part of a JSON record that is read, and two ways to read it.

A shape names the keys that are wanted and the JSON type each must have:

    TEXT, WHOLE, NUMBER, TRUTH   a string, an integer, any number, a boolean
    SELDOM_TEXT                  a string, where snapshots mostly have something else
    JSON                         any value, kept as compact text
    [shape]                      an array
    {"key": shape, ...}          an object

Both ways give the same typed columns.  A value of another type counts as
absent (NULL), nothing is coerced.

* ``Shape.ddl`` is a schema for from_json(), which is fast and skips what is
  not asked for.  It has gaps: it turns any value into a string where one is
  expected, and does not tell an explicit null from a missing key.
  ``trusted`` says whether a record may have fallen into a gap.
* ``strict`` reads the same columns from VARIANT values and has no gaps, at
  several times the cost.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholarlake.functions import strict_json as js

TEXT = "string"
WHOLE = "bigint"
NUMBER = "double"
TRUTH = "boolean"
JSON = "variant"
# Read as VARIANT from the start, so that what is no string raises no doubt.
SELDOM_TEXT = "seldom"

Shape = str | list | dict

# What from_json() gives for a string column when the value is no string: the
# text of a number, boolean, object or array, here as one of several lines.
# Real strings may look the same, which costs them a second reading and nothing
# else.
NOT_SURELY_TEXT = (
    r'(?md)^(?:[\[{"]|(?:true|false|-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)$)'
)


def ddl(shape: Shape) -> str:
    """The Spark type of a shape, as from_json() reads it."""
    if isinstance(shape, list):
        return f"array<{ddl(shape[0])}>"
    if isinstance(shape, dict):
        return f"struct<{', '.join(f'`{key}`: {ddl(part)}' for key, part in shape.items())}>"
    return JSON if shape == SELDOM_TEXT else shape


def trusted(value: Column, shape: Shape) -> Column:
    """Whether a value read by from_json() is what ``strict`` would give.

    Apart from the difference between a missing object and null.
    """
    texts = _leaves(value, shape, TEXT)
    if not texts:
        return F.lit(True)
    return ~F.concat_ws("\n", *texts).rlike(NOT_SURELY_TEXT)


def infinite(value: Column, shape: Shape) -> Column | None:
    """Whether a number in a value was beyond double range; None without numbers."""
    found = None
    leaves, in_arrays = (_leaves(value, shape, NUMBER, told) for told in (False, True))
    for leaf, many in zip(leaves, in_arrays, strict=True):
        for limit in (float("inf"), float("-inf")):
            own = F.array_contains(leaf, F.lit(limit)) if many else leaf == F.lit(limit)
            found = own if found is None else found | own
    return found


def settled(value: Column, shape: Shape) -> Column:
    """The value with its SELDOM_TEXT parts as strings."""
    if shape == SELDOM_TEXT:
        return js.text(value)
    if not isinstance(shape, dict) or SELDOM_TEXT not in shape.values():
        return value
    parts = [settled(value[key], part).alias(key) for key, part in shape.items()]
    return F.when(value.isNotNull(), F.struct(*parts))


def keys_of(shape: Shape, kind: str) -> set[str]:
    """The names of the keys that hold values of one kind, at any depth."""
    if isinstance(shape, list):
        return keys_of(shape[0], kind)
    if not isinstance(shape, dict):
        return set()
    own = {key for key, part in shape.items() if part == kind}
    return own.union(*(keys_of(part, kind) for part in shape.values()))


def _leaves(
    value: Column, shape: Shape, kind: str, told: bool = False, inside_array: bool = False
) -> list:
    """All parts of one kind in a value, as columns of it or of arrays of it.

    ``told``: instead of each column, whether it is one of arrays.
    """
    if isinstance(shape, list):
        if inside_array:
            value = F.flatten(F.array_compact(value))
        return _leaves(value, shape[0], kind, told, inside_array=True)
    if isinstance(shape, dict):
        return [
            column
            for key, part in shape.items()
            for column in _leaves(value[key], part, kind, told, inside_array)
        ]
    return [inside_array if told else value] if shape == kind else []


def _fields(source: Column, shape: dict[str, Shape]) -> Column:
    return F.struct(*(strict(source[key], part).alias(key) for key, part in shape.items()))


def strict(v: Column, shape: Shape) -> Column:
    """The same columns from a VARIANT.

    An object is NULL only if its key is missing; for null and for values that
    are no objects it has NULL in all its fields.
    """
    if isinstance(shape, list):
        if shape[0] == TEXT:
            return js.texts(v)
        if isinstance(shape[0], dict):
            # One look into an object gives all its fields; what is none has NULL in all of them.
            objects = F.transform(js.items(v), lambda e: js.fields(e, shape[0]))
            return F.transform(objects, lambda o: _fields(o, shape[0]))
        return F.transform(js.items(v), lambda e: strict(e, shape[0]))
    if isinstance(shape, dict):
        parts = [strict(js.at(v, key), part).alias(key) for key, part in shape.items()]
        return F.when(js.present(v), F.struct(*parts))
    return {TEXT: js.text, WHOLE: js.whole, NUMBER: js.number, TRUTH: js.truth}.get(
        shape, js.itself
    )(v)
