"""Numbers in JSON text that are not 64-bit integers: doubles, in their shortest form.

VARIANT keeps a number with a fraction as a decimal, whose trailing zeros it drops, and
prints doubles as the JVM does.  JSON text wants every number that is no integer of 64
bits as a double: ``5.0`` stays ``5.0``, ``1e2`` is ``100.0``, ``1E30`` is ``1e30``.  So
such text is rewritten before it is parsed (``with_doubles``: what is to be a double gets
an exponent, which VARIANT takes as one) and after it is printed (``shortest``).

Both only touch what is outside of strings.  That is found without a pattern over whole
strings, which could exhaust the stack: with escaped backslashes and quotes masked, every
other part between quotes is a string.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholarlake.functions.strict_json import once

# Characters that valid JSON text cannot hold unescaped.
MASKS = (("\\\\", "\x01"), ('\\"', "\x02"))

# The least and the greatest integer that stays one; digits before the
# point from which on, and zeros behind it up to which, a number has no exponent.
LEAST, GREATEST = -(1 << 63), (1 << 64) - 1
PLAIN_DIGITS = 16
PLAIN_ZEROS = 4


def _above(limit: int) -> str:
    """A pattern of the digits of every integer greater than ``limit``."""
    digits = str(limit)
    greater = [
        f"{digits[:i]}[{int(d) + 1}-9][0-9]{{{len(digits) - i - 1}}}"
        for i, d in enumerate(digits)
        if d != "9"
    ]
    return f"(?:[1-9][0-9]{{{len(digits)},}}|{'|'.join(greater)})"


_BEFORE, _AFTER = r"(?<![0-9.eE+-])", r"(?![0-9.eE])"
TO_DOUBLE = (
    rf"{_BEFORE}(-?[0-9]+\.[0-9]+|-0|{_above(GREATEST)}|-{_above(-LEAST)}){_AFTER}"
)
MINUS_ZERO = "-0(?![.0-9])"
WITH_EXPONENT = r"-?[0-9]+(?:\.[0-9]+)?[eE][+-]?[0-9]+"
JVM_DOUBLE = r"-?[0-9]+\.[0-9]+E-?[0-9]+"

# The least characters of what TO_DOUBLE and JVM_DOUBLE find: most text between strings has
# fewer, and is not searched.
LEAST_TO_DOUBLE, LEAST_JVM_DOUBLE = len("-0"), len("1.0E5")


def perhaps(line: Column, known: Sequence[str] = ()) -> Column:
    """Whether text may hold a number that ``with_doubles`` changes, or one with an exponent.

    Numbers right behind one of the ``known`` keys do not count.  Cheap, and sometimes
    wrong: strings may hold what looks like such a number.
    """
    # The look-behind comes last: it is tried where everything else fits.
    not_known = "".join(f'(?<!"{key}":)' for key in known)
    return line.rlike(rf"[:,\[\s]{not_known}(?:-?[0-9]+[.eE]|{MINUS_ZERO}|-?[0-9]{{19}})")


def minus_zero(line: Column) -> Column:
    """Whether text may hold the integer -0, which VARIANT takes for 0."""
    # The minus comes first: few characters are one, many may stand before it.
    return line.rlike(rf"{MINUS_ZERO}(?<=[:,\[\s]-0)")


def zero(text: Column) -> Column:
    """Whether compact JSON text may hold the integer 0."""
    return text.rlike(r"(?:^|[:,\[])0(?![0-9.])")


def _masked(text: Column) -> Column:
    for escape, mask in MASKS:
        text = F.replace(text, F.lit(escape), F.lit(mask))
    return text


def _outside(text: Column, least: int, change: Callable[[Column], Column]) -> Column:
    """JSON text with what is outside of its strings, and of ``least`` characters, changed."""
    parts = F.split(_masked(text), '"', -1)

    def changed_part(part: Column, i: Column) -> Column:
        changes = (i % 2 == 0) & (F.octet_length(part) >= least)
        return F.when(changes, change(part)).otherwise(part)

    changed = F.transform(parts, changed_part)
    out = F.array_join(changed, '"')
    for escape, mask in reversed(MASKS):
        out = F.replace(out, F.lit(mask), F.lit(escape))
    return out


def with_doubles(text: Column) -> Column:
    """JSON text in which every number that is no 64-bit integer has an exponent."""
    return _outside(
        text, LEAST_TO_DOUBLE, lambda part: F.regexp_replace(part, TO_DOUBLE, "$1e0")
    )


def beyond_double(text: Column) -> Column:
    """Whether a number of ``with_doubles`` is beyond double range."""
    parts = F.filter(F.split(_masked(text), '"', -1), lambda _, i: i % 2 == 0)
    numbers = F.regexp_extract_all(F.array_join(parts, " "), F.lit(f"({WITH_EXPONENT})"))
    return F.exists(numbers, lambda n: F.abs(n.cast("double")) == float("inf"))


def _shortest(number: Column) -> Column:
    """A double with an exponent, as the JVM prints it, in the form of JSON text."""
    return once(F.split(F.translate(number, "E", "."), r"\."), _of_parts)


def _of_parts(parts: Column) -> Column:
    """The same from a double's digit with its sign, its fraction and its exponent."""
    sign = F.when(parts[0].startswith("-"), "-").otherwise("")
    first = F.right(parts[0], F.lit(1))
    rest = parts[1]
    power = parts[2].cast("int")
    short = F.when(rest == "0", "").otherwise(rest)
    before = F.rpad(rest, F.greatest(power, F.lit(0)), F.lit("0"))
    behind = F.when(
        F.length(rest) > power, F.substr(rest, F.greatest(power, F.lit(0)) + 1)
    ).otherwise("0")
    zeros = F.repeat(F.lit("0"), -power - 1)
    return (
        F.when((power >= 0) & (power < PLAIN_DIGITS), F.concat(sign, first, before, F.lit("."), behind))
        .when((power < 0) & (power >= -PLAIN_ZEROS - 1), F.concat(sign, F.lit("0."), zeros, first, short))
        .otherwise(
            F.concat(
                sign, first, F.when(short == "", "").otherwise(F.concat(F.lit("."), short)),
                F.lit("e"), power.cast("string"),
            )
        )
    )


def shortest(text: Column) -> Column:
    """Compact JSON text with its doubles, printed by the JVM, in their shortest form."""

    def change(part: Column) -> Column:
        numbers = F.transform(F.regexp_extract_all(part, F.lit(f"({JVM_DOUBLE})")), _shortest)
        between = F.split(part, JVM_DOUBLE, -1)
        return F.array_join(
            F.zip_with(between, numbers, lambda a, n: F.concat(a, F.coalesce(n, F.lit("")))), ""
        )

    some = text.rlike("[0-9]E-?[0-9]")
    return F.when(some, _outside(text, LEAST_JVM_DOUBLE, change)).otherwise(text)
