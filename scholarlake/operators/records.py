"""Lines to typed records, typed records to table rows.

A record has ``id``, ``file_key``, ``line_no`` and the top-level keys its tables
read, in the types of their shapes.  No JSON tree is left in it, so what later
steps shuffle or store is only what the tables hold.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarlake.functions import json_numbers as numbers
from scholarlake.functions import strict_json as js
from scholarlake.functions.shape import (
    JSON,
    NUMBER,
    SELDOM_TEXT,
    TEXT,
    Shape,
    ddl,
    infinite,
    keys_of,
    settled,
    strict,
    trusted,
)
from scholarlake.functions.strict_json import once

# from_json() accepts more than JSON unless told otherwise.
STRICT_SYNTAX = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
CORRUPT = "_corrupt"

# What separates tokens in JSON; lines that hold nothing but white space.
JSON_SPACE = " \t\r\n"
BLANK_LINE = r"^[\s\u0085\p{Z}]*$"

# Escapes that stand for themselves or in pairs; what is left of others is an error.
WHOLE_ESCAPES = r"\\\\|\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}"
HALF_ESCAPE = r"\\u[dD][89a-fA-F]"


@dataclass(frozen=True)
class RecordTable:
    """How one output table is cut out of the records of an entity.

    The rows come from the record itself; from an object in it, none if the key
    is missing (``child``); or from the elements of an array (``each``).
    """

    name: str
    id_column: str  # the name of the record's id in this table
    shape: dict[str, Shape]  # top-level keys
    columns: Callable[[Callable[[str], Column]], dict[str, Column]]  # from a field getter
    child: str | None = None
    each: str | None = None
    required: str | None = None  # rows that lack this column are dropped


def record_shape(tables: Sequence[RecordTable]) -> dict[str, Shape]:
    return {key: shape for table in tables for key, shape in table.shape.items()}


def parse_records(lines: DataFrame, tables: Sequence[RecordTable]) -> DataFrame:
    """Lines (file_key, line_no, value) to the records of ``tables``.

    Every line is parsed into typed columns; the few that may have lost
    something on the way are parsed again, strictly.  A malformed line fails
    the run: anything that is not exactly one JSON value, bytes that are not
    UTF-8, half a surrogate pair, a number that is read and beyond double range.

    Blank lines and records whose id is not a string have a NULL id and must be
    dropped by the caller.  A filter here could be pushed below the parse and
    would then parse everything once more.

    Spark's parsers stop after the first value.  So each line is put into an
    array, before an element that only this call can know, below a key that only
    this call can know.  The line is one value if and only if that array comes
    back with two elements, the second of them ours: text that closes the array
    or the object early leaves ours out, a second value makes it longer, and
    anything else is a syntax error.
    """
    shape = {"id": TEXT, **record_shape(tables)}
    ours = f"_{uuid.uuid4().hex}"
    enclosed, one_value = _enclosing(ours)
    fields = ", ".join(f"`{key}`: {ddl(part)}" for key, part in shape.items())
    variants = ", ".join(f"`{key}`: variant" for key in shape)

    # Parsers are not compiled, nor is what stands in their arguments: so these are columns of
    # their own.  What is no object is not parsed here; a failure costs more than a record.
    line = F.col("value")
    framed = f"{ours}_framed"
    sound = lines.withColumn("value", _sound("value"))
    parsed = sound.withColumn(framed, F.when(_is_object(line), enclosed(line))).withColumn(
        "typed",
        F.from_json(
            F.col(framed),
            f"`{ours}` array<struct<{fields}, `{ours}`: boolean>>, {CORRUPT} string",
            {**STRICT_SYNTAX, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
        ),
    )
    array = F.col("typed")[ours]
    typed = F.get(array, F.lit(0))
    whole = F.col("typed")[CORRUPT].isNull() & F.coalesce(one_value(array), F.lit(False))
    regular = whole & typed.isNotNull() & trusted(typed, shape)
    # A NULL object may stand for a missing key or for null.
    unclear = {
        table.child: typed[table.child].isNull()
        for table in tables
        if table.child and not table.required
    }
    judged = parsed.withColumn("regular", F.coalesce(regular, F.lit(False)))
    second = ~F.col("regular")
    in_doubt = F.lit(False)
    for key, is_unclear in unclear.items():
        in_doubt = in_doubt | (is_unclear & _may_have(line, key))

    is_object = F.col(framed).isNotNull()
    again = F.from_json(
        F.when(second, F.col(framed)),
        f"`{ours}` array<struct<{variants}, `{ours}`: boolean>>",
        {**STRICT_SYNTAX, "mode": "FAILFAST"},
    )[ours]
    # Values that are no objects are skipped, but they must be one value as well.
    other = F.parse_json(F.concat(F.lit("["), line, F.lit(f',"{ours}"]')))
    is_other = js.text(js.element(other, 1)) == ours
    malformed = F.raise_error(F.concat(F.lit("MALFORMED line, not one JSON value: "), line))
    both = judged.withColumn("again", again)
    # Of a sound record with NULL objects only the keys are wanted: an object whose key is there
    # was null.
    keys_there = f"{ours}_keys"
    if unclear:
        both = both.withColumn(
            keys_there, F.when(F.col("regular") & in_doubt, F.json_object_keys(line))
        )
    found = F.col("again")
    checked = (
        F.when(found.isNotNull() & one_value(found), found[0])
        .when(found.isNotNull(), malformed)
        .when(~second | is_object | line.rlike(BLANK_LINE), F.lit(None))
        .when(F.coalesce(is_other, F.lit(False)), F.lit(None))
        .otherwise(malformed)
    )
    both = both.withColumn("json", checked)
    json = F.col("json")

    def field(key: str) -> Column:
        part = shape[key]
        value = typed[key]
        if key in unclear:
            nothing = F.struct(*(F.lit(None).cast(ddl(p)).alias(k) for k, p in part.items()))
            is_null = F.array_contains(F.col(keys_there), F.lit(key))
            value = F.when(unclear[key], F.when(is_null, nothing)).otherwise(value)
        return F.when(F.col("regular"), value).otherwise(strict(json[key], part)).alias(key)

    read = both.select(
        *map(field, shape),
        "file_key",
        "line_no",
        # Last sort key of first_per_id.  While it is in use, no filter moves
        # below this step.
        F.monotonically_increasing_id().alias("arrival"),
        F.col("value").alias(ours),
    )

    # Used several times from here on, so they are columns by now.
    def checked_part(key: str, part: Shape) -> Column:
        value = F.col(key)
        too_large = infinite(value, part)
        if too_large is not None:
            error = F.raise_error(F.concat(F.lit("MALFORMED number: "), F.col(ours)))
            value = F.when(too_large, error).otherwise(value)
        return value if part == JSON else settled(value, part)

    changed = {
        key: checked_part(key, part)
        for key, part in shape.items()
        if keys_of({key: part}, NUMBER) or keys_of({key: part}, SELDOM_TEXT)
    }
    if changed:
        read = read.withColumns(changed)
    keys = [key for key, part in shape.items() if part == JSON]
    return _as_text(read, keys, ours, sorted(keys_of(shape, NUMBER))).drop(ours)


def _as_text(
    records: DataFrame, keys: Sequence[str], line: str, known: Sequence[str]
) -> DataFrame:
    """Records with the values of ``keys`` as JSON text; ``known`` keys hold numbers.

    VARIANT drops zeros at the end of a fraction, and the sign of -0.  Records that hold a
    number that is no integer below these keys, which are few, are parsed once more for it.
    """
    if not keys:
        return records
    # What is told by the value comes first: patterns over whole lines cost more than parsing.
    text = {key: f"{line}_{key}" for key in keys}
    records = records.withColumns({text[key]: js.compact(F.col(key)) for key in keys})
    perhaps = numbers.perhaps(F.col(line), known)

    def doubt(key: str) -> Column:
        # Never NULL: behind a NULL the lines of records without a value would be searched too.
        broken = F.coalesce(js.fractional(F.col(key)), F.lit(False))
        zero = F.coalesce(numbers.zero(F.col(text[key])), F.lit(False))
        return F.coalesce(
            (broken & perhaps) | (zero & numbers.minus_zero(F.col(line))), F.lit(False)
        )

    doubtful = {key: doubt(key) for key in keys}
    too_large = F.raise_error(F.concat(F.lit("MALFORMED number: "), F.col(line)))

    def exact(key: str) -> Column:
        def printed(text: Column) -> Column:
            value = js.compact(js.at(F.parse_json(text), key))
            return F.when(numbers.beyond_double(text), too_large).otherwise(value)

        # Each step once, and only for these records.
        return once(once(numbers.with_doubles(F.col(line)), printed), numbers.shortest)

    return records.withColumns(
        {
            key: F.when(doubted, exact(key)).otherwise(F.col(text[key]))
            for key, doubted in doubtful.items()
        }
    ).drop(*text.values())


def _enclosing(ours: str) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
    """What puts a line into an array of ``ours``, and what tells that it is one value there."""

    def enclosed(line: Column) -> Column:
        return F.concat(F.lit(f'{{"{ours}":['), line, F.lit(f',{{"{ours}":true}}]}}'))

    def one_value(array: Column) -> Column:
        return (F.size(array) == 2) & F.coalesce(array[1][ours], F.lit(False))

    return enclosed, one_value


def _is_object(line: Column) -> Column:
    return F.ltrim(line, F.lit(JSON_SPACE)).startswith("{")


def _may_have(line: Column, key: str) -> Column:
    """Whether a key may stand in a line; without escapes it stands there as it is."""
    return F.contains(line, F.lit(f'"{key}"')) | F.contains(line, F.lit("\\u"))


def _half_pair(line: Column) -> Column:
    """Whether one of a line's escapes is half a surrogate pair."""
    broken = F.regexp_replace(line, WHOLE_ESCAPES, "").rlike(HALF_ESCAPE)
    some = F.contains(line, F.lit("\\ud")) | F.contains(line, F.lit("\\uD"))
    # Most lines hold no such escape at all, and are searched once.
    return F.contains(line, F.lit("\\u")) & some & broken


def _sound(value: str) -> Column:
    """The line, if its bytes are UTF-8 and its escapes whole; else the run fails."""
    line = F.col(value)
    error = F.raise_error(F.concat(F.lit("MALFORMED line, half a surrogate pair: "), line))
    # The bytes are validated in one place only: each one is a pass over the line.
    return F.when(_half_pair(line), error).otherwise(F.validate_utf8(line))


# Why a line fails a run.
NOT_UTF8 = "bytes that are not UTF-8"
HALF_PAIR = "half a surrogate pair"
NOT_ONE_VALUE = "not one JSON value"
TOO_LARGE = "a number beyond double range"


def malformed_lines(lines: DataFrame, tables: Sequence[RecordTable]) -> DataFrame:
    """(file_key, line_no, reason): the lines on which ``parse_records`` fails the run.

    One scan without a shuffle.  Every line is read from VARIANT, whose parser gives NULL
    for what is no JSON; the rule of one value per line is that of ``parse_records``.
    """
    shape = {"id": TEXT, **record_shape(tables)}
    ours = f"_{uuid.uuid4().hex}"
    enclosed, one_value = _enclosing(ours)
    variants = ", ".join(f"`{key}`: variant" for key in shape)
    line = F.col("value")
    unsound = F.when(~F.is_valid_utf8(line), NOT_UTF8).when(_half_pair(line), HALF_PAIR)
    # What is used more than once, or below a parser, which is not compiled, is a column of
    # its own.
    sound = lines.withColumn("reason", unsound).withColumn(
        "sound", F.when(F.col("reason").isNull() & ~line.rlike(BLANK_LINE), line)
    )
    sound_line = F.col("sound")
    is_object = F.coalesce(_is_object(sound_line), F.lit(False))
    framed = sound.withColumns(
        {
            "framed": F.when(is_object, enclosed(sound_line)),
            "listed": F.when(~is_object, F.concat(F.lit("["), sound_line, F.lit(f',"{ours}"]'))),
        }
    )
    objects = F.from_json(
        F.col("framed"),
        f"`{ours}` array<struct<{variants}, `{ours}`: boolean>>, {CORRUPT} string",
        {**STRICT_SYNTAX, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    others = F.try_parse_json(F.col("listed"))
    read = framed.withColumns({"object": objects, "other": others})
    found = F.col("object")[ours]
    is_framed = F.col("framed").isNotNull()
    whole = F.when(
        is_framed, F.col("object")[CORRUPT].isNull() & one_value(found)
    ).otherwise(js.text(js.element(F.col("other"), 1)) == ours)
    record = F.get(found, F.lit(0))
    # The numbers of the whole line are looked at once, and where one of the values may hold some.
    fractional = too_large = F.lit(False)
    for key, part in shape.items():
        if part == JSON:
            fractional = fractional | F.coalesce(js.fractional(record[key]), F.lit(False))
        elif (own := infinite(strict(record[key], part), part)) is not None:
            too_large = too_large | F.coalesce(own, F.lit(False))
    beyond = once(
        once(F.when(fractional, sound_line), numbers.with_doubles), numbers.beyond_double
    )
    too_large = too_large | F.coalesce(beyond, F.lit(False))
    reason = (
        F.when(F.col("reason").isNotNull() | sound_line.isNull(), F.col("reason"))
        .when(~F.coalesce(whole, F.lit(False)), NOT_ONE_VALUE)
        .when(is_framed & too_large, TOO_LARGE)
    )
    told = read.select(
        "file_key",
        "line_no",
        reason.alias("reason"),
        # In use below, so that the filter does not move under the parse and repeat it.
        F.monotonically_increasing_id().alias("arrival"),
    )
    return told.where(F.col("reason").isNotNull() & (F.col("arrival") >= 0)).drop("arrival")


def table_rows(records: DataFrame, table: RecordTable) -> DataFrame:
    """The rows of one table; a narrow step over records."""
    key = F.col("id").alias(table.id_column)
    if table.each:
        records = records.select("id", F.explode(table.each).alias("part"))
        base = F.col("part")
    elif table.child:
        records = records.where(F.col(table.child).isNotNull())
        base = F.col(table.child)
    else:
        base = None

    def get(path: str) -> Column:
        if base is None:
            return F.col(path)
        column = base
        for step in path.split(".") if path else ():
            column = column[step]
        return column

    columns = [column.alias(name) for name, column in table.columns(get).items()]
    rows = records.select(key, *columns)
    return rows.where(F.col(table.required).isNotNull()) if table.required else rows
