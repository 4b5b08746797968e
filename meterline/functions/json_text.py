"""Strict JSON in, canonical JSON out: keys by UTF-16 units, no spaces, numbers and strings as JavaScript prints them."""

from __future__ import annotations

import json
import re
from decimal import Decimal

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType, StructField, StructType

SURROGATE = re.compile("[\ud800-\udfff]")


class Rendered(str):
    """JSON text that is put out as it stands."""


class JsonProblem(ValueError):
    """Why a text has no canonical form; the message is the reason."""


def _whole(literal: str) -> float | int:
    value = int(literal) if len(literal) < 16 else float(literal)
    return _finite(value)


def _finite(value: float) -> float:
    if value in (float("inf"), float("-inf")):
        raise JsonProblem("number out of range")
    return value


def _constant(_: str) -> None:
    raise JsonProblem("not JSON")


def _object(pairs: list[tuple]) -> dict:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise JsonProblem("repeated key")
    return out


def parse(text: str):
    """The value of a JSON text; numbers are doubles (or equal whole numbers). Anything else, a key given twice or a number beyond doubles is a JsonProblem."""
    try:
        return json.loads(text, parse_int=_whole, parse_float=lambda x: _finite(float(x)), parse_constant=_constant, object_pairs_hook=_object)
    except JsonProblem:
        raise
    except RecursionError:
        raise JsonProblem("too deep") from None
    except ValueError:
        raise JsonProblem("not JSON") from None


def number(x: float | int) -> str:
    """A double as JavaScript prints it: the shortest digits, with an exponent below 1e-6 and from 1e21 on."""
    if isinstance(x, int) or x == int(x) and abs(x) < 2**53:
        return str(int(x))
    sign, digits, exponent = Decimal(repr(x)).as_tuple()
    d = "".join(map(str, digits)).rstrip("0")
    point = len(digits) + exponent  # of the digits so many stand before the point
    if len(d) <= point <= 21:
        out = d + "0" * (point - len(d))
    elif 0 < point <= 21:
        out = f"{d[:point]}.{d[point:]}"
    elif -6 < point <= 0:
        out = f"0.{'0' * -point}{d}"
    else:
        out = f"{d[0]}{'.' + d[1:] if d[1:] else ''}e{'+' if point > 0 else '-'}{abs(point - 1)}"
    return "-" * sign + out


def string(text: str) -> str:
    return SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", json.dumps(text, ensure_ascii=False))


def write(value) -> str:
    if isinstance(value, Rendered):
        return str(value)
    if isinstance(value, str):
        return string(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{string(k)}:{write(value[k])}" for k in sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(write, value)) + "]"
    if value is None or isinstance(value, bool):
        return {None: "null", True: "true", False: "false"}[value]
    return number(value)


def attempt(text: str | None) -> tuple[str | None, str | None]:
    """The canonical form of a text and why there is none."""
    try:
        return (None if text is None else write(parse(text))), None
    except JsonProblem as error:
        return None, str(error)
    except RecursionError:
        return None, "too deep"


@pandas_udf(StructType([StructField("json", StringType()), StructField("problem", StringType())]))
def canonical(text: pd.Series) -> pd.DataFrame:
    """Canonical JSON, or null and why there is none: not JSON, repeated key, number out of range, too deep. Null stays null, without a problem."""
    return pd.DataFrame([attempt(t) for t in text], columns=["json", "problem"], dtype=object)


@pandas_udf(StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """Canonical JSON; null for null and for what is no strict JSON (canonical tells why)."""
    return pd.Series([attempt(t)[0] for t in text], dtype=object)
