"""JSON payloads that any reader accepts: numbers no column can hold become strings.

Only texts that may hold such a number reach Python (Arrow batches); the others stay as they are, byte for byte.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that need a look: non-finite tokens, typed wrappers, integers of 19 digits, large exponents.
SUSPECT = r'NaN|Infinity|"\$(number|bigint)|[0-9]{19}|[0-9.][eE]\+?[0-9]{2}'
RESULT = "struct<json: string, coercions: array<struct<rule: string, original: string, coerced: string>>>"


class _Number(str):
    """A number's literal."""


def fixed_digits(value: float) -> str:
    """The shortest digits of value, without an exponent."""
    mantissa, _, power = repr(abs(value)).partition("e")
    whole, _, part = mantissa.partition(".")
    part = "" if part == "0" else part
    text = (whole + part).ljust(len(whole) + int(power or 0), "0")
    return ("-" if value < 0 else "") + (text.lstrip("0") or "0")


def sanitize(text: str) -> tuple[str, list[dict]]:
    """Sanitised JSON text, and what was changed."""
    found: list[dict] = []

    def note(rule: str, original: str, coerced: str) -> str:
        found.append({"rule": rule, "original": original, "coerced": coerced})
        return json.dumps(coerced, ensure_ascii=False)

    def number(literal: str) -> str:
        value = float(literal)
        if value != value or value in (float("inf"), float("-inf")):
            name = "NaN" if value != value else "Infinity" if value > 0 else "-Infinity"
            return note("stringify_nonfinite", name, name)
        if 2.0**64 <= value < 1e21 or -1e21 < value <= -(2.0**63) - 1 and value < -(2.0**63):
            return note("stringify_int64_overflow", literal, fixed_digits(value))
        return literal

    def write(x) -> str:
        if isinstance(x, _Number):
            return number(x)
        if isinstance(x, list):
            return "[" + ",".join(map(write, x)) + "]"
        if isinstance(x, dict):
            if len(x) == 1:
                (key, value), *_ = x.items()
                if key == "$date":
                    return json.dumps({key: value}, ensure_ascii=False, separators=(",", ":"), default=str)
                if key in ("$numberDouble", "$numberInt") and isinstance(value, str):
                    return number(value)
                rule = {"$numberLong": "stringify_bson_long", "$numberDecimal": "stringify_bson_decimal128", "$bigint": "stringify_bigint"}.get(key)
                if rule and isinstance(value, str):
                    return note(rule, value, value)
            return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{write(v)}" for k, v in x.items()) + "}"
        return json.dumps(x, ensure_ascii=False)

    parsed = json.loads(text, parse_int=_Number, parse_float=_Number, parse_constant=_Number)
    out = write(parsed)
    return (out, found) if found else (text, [])


def _sanitize(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in texts:
        done = [(None, []) if t is None else sanitize(t) for t in s]
        yield pd.DataFrame(done, columns=["json", "coercions"])


def sanitized_all(json_texts: dict[str, Column]) -> Column:
    """struct of sanitized() for several texts of a row, by one call of Python: it sees only texts that need a look."""
    suspect = F.struct(*[F.when(c.rlike(SUSPECT), c).alias(k) for k, c in json_texts.items()])
    any_ = None
    for k in json_texts:
        any_ = suspect[k].isNotNull() if any_ is None else any_ | suspect[k].isNotNull()

    def look(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows:
            yield pd.DataFrame({k: [None if t is None else dict(zip(("json", "coercions"), sanitize(t), strict=True)) for t in frame[k]] for k in frame.columns})

    return F.pandas_udf(look, f"struct<{', '.join(f'{k}: {RESULT}' for k in json_texts)}>")(F.when(any_, suspect))


def sanitized(json_text: Column) -> Column:
    """struct<json, coercions> of a JSON text (null stays null)."""
    looked = F.pandas_udf(_sanitize, RESULT)(F.when(json_text.rlike(SUSPECT), json_text))
    none = F.array().cast("array<struct<rule: string, original: string, coerced: string>>")
    return F.struct(F.coalesce(looked["json"], json_text).alias("json"), F.coalesce(looked["coercions"], none).alias("coercions"))
