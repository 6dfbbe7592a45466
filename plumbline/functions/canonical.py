"""Test corpora: values that JSON can't write, and rows in one canonical form."""

from __future__ import annotations

import json

#: How a wrapper {"$$t": kind, ...} is read, as canonical Extended JSON.
WRAPPED = {
    "nan": lambda w: {"$numberDouble": "NaN"},
    "inf": lambda w: {"$numberDouble": "Infinity"},
    "-inf": lambda w: {"$numberDouble": "-Infinity"},
    "date": lambda w: {"$date": {"$numberLong": str(w["ms"])}},
    "decimal128": lambda w: {"$numberDecimal": w["v"]},
    "driverLong": lambda w: float(w["v"]) if abs(int(w["v"])) > 1 << 53 else int(w["v"]),
    "bigstring": lambda w: w["c"] * w["n"],
}


def decode(value):
    """A corpus value as Extended JSON; members of kind "undef" are left out, and null in lists."""
    absent = lambda x: isinstance(x, dict) and x.get("$$t") == "undef"
    if isinstance(value, list):
        return [None if absent(x) else decode(x) for x in value]
    if not isinstance(value, dict):
        return value
    if isinstance(value.get("$$t"), str):
        if value["$$t"] not in WRAPPED:
            raise ValueError(f"no such wrapper: {value['$$t']}")
        return WRAPPED[value["$$t"]](value)
    return {k: decode(x) for k, x in value.items() if not absent(x)}


def sorted_keys(value):
    """The value with the keys of all its objects in order."""
    if isinstance(value, dict):
        return {k: sorted_keys(value[k]) for k in sorted(value)}
    return [sorted_keys(x) for x in value] if isinstance(value, list) else value


def effective_row(row: dict, payloads: tuple[str, ...] = ("up", "custom", "cmp", "sg")) -> dict:
    """A row as a reader sees it: payloads parsed with sorted keys, absent columns left out."""
    parse = lambda k, x: sorted_keys(json.loads(x)) if k in payloads else x
    return {k: parse(k, x) for k, x in sorted(row.items()) if x is not None}
