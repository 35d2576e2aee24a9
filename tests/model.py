"""What a record must be read as, value by value, in plain Python."""

from __future__ import annotations

import json

from scholarlake.functions.shape import JSON, NUMBER, SELDOM_TEXT, TEXT, TRUTH, WHOLE

MISSING = object()


def is_int(v):
    return isinstance(v, int) and not isinstance(v, bool)


def shortest(x):
    """The digits of repr, laid out as JSON text wants them."""
    sign, digits = ("-", repr(-x)) if str(x).startswith("-") else ("", repr(x))
    mantissa, _, power = digits.partition("e")
    whole, _, rest = mantissa.partition(".")
    point = len(whole) + int(power or 0)
    digits = (whole + rest).lstrip("0")
    point -= len(whole + rest) - len(digits)
    digits = digits.rstrip("0") or "0"
    if digits == "0":
        return sign + "0.0"
    if 0 < point <= 16:
        return f"{sign}{digits[:point].ljust(point, '0')}.{digits[point:] or '0'}"
    if -5 < point <= 0:
        return f"{sign}0.{'0' * -point}{digits}"
    return f"{sign}{digits[0]}{'.' + digits[1:] if digits[1:] else ''}e{point - 1}"


def json_text(v):
    """Compact text with sorted keys; numbers beyond 64-bit integers are doubles."""
    if isinstance(v, dict):
        pairs = sorted(v.items(), key=lambda p: p[0].encode())
        return "{" + ",".join(f"{json_text(k)}:{json_text(e)}" for k, e in pairs) + "}"
    if isinstance(v, list):
        return "[" + ",".join(map(json_text, v)) + "]"
    if is_int(v) and not -(2**63) <= v < 2**64:
        v = float(v)
    return shortest(v) if isinstance(v, float) else json.dumps(v, ensure_ascii=False)


def read(v, shape):
    if isinstance(shape, list):
        return [read(e, shape[0]) for e in v] if isinstance(v, list) else None
    if isinstance(shape, dict):
        if v is MISSING:
            return None
        source = v if isinstance(v, dict) else {}
        return {key: read(source.get(key, MISSING), part) for key, part in shape.items()}
    if shape == JSON:
        return None if v is MISSING else json_text(v)
    if v is MISSING:
        return None
    good = {
        TEXT: isinstance(v, str),
        SELDOM_TEXT: isinstance(v, str),
        WHOLE: is_int(v) and -(2**63) <= v < 2**63,
        NUMBER: is_int(v) or isinstance(v, float),
        TRUTH: isinstance(v, bool),
    }[shape]
    return (float(v) if shape == NUMBER else v) if good else None


def blank(value, shape):
    """``value`` with objects of nothing but NULLs as NULL, below the top level.

    Whether such an object is NULL itself makes no difference to any table.
    """
    if isinstance(shape, list):
        return value if value is None else [blank(e, shape[0]) for e in value]
    if isinstance(shape, dict) and value is not None:
        parts = {key: blank(value[key], part) for key, part in shape.items()}
        return parts if any(p is not None for p in parts.values()) else None
    return value
