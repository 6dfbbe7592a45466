"""Scalar rules on typed values, as native column expressions.

A value is Extended JSON text. `envelope` finds its kind once; the other functions take the envelope
struct<kind, str, num, ms>. JavaScript's Number(), String() and trim() are reproduced where rules depend on them.

`let` binds a value once; `each` applies a rule to several columns by one lambda, so that a row's fields cost one expression
in the plan and not one each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.schema import MILLIS_FROM, SECONDS_FROM, TIME_MAX, TIME_MIN, UINT32_MAX

#: What JavaScript's trim removes.
TRIMMED = r"[\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?)$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, with value in the plan once however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def each(columns: list[Column], body: Callable[[Column], Column]) -> Column:
    """An array with body of each column."""
    return F.transform(F.array(*columns), body)


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, f"^{TRIMMED}+|{TRIMMED}+$", "")


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.length(trimmed(text)) == 0)


def blank_to_null(text: Column) -> Column:
    return F.when(~is_blank(text), text)


def first_non_blank(*texts: Column) -> Column:
    return F.coalesce(*[blank_to_null(t) for t in texts])


def parse_number(text: Column) -> Column:
    """Number(text): blank is 0, hex, octal and binary literals count, anything else that isn't a decimal is null."""

    def read(t: Column) -> Column:
        based = lambda base: F.conv(F.substring(t, 3, 1 << 20), base, 10).cast("double")
        return (
            F.when(t == "", F.lit(0.0))
            .when(t.rlike(DECIMAL), t.try_cast("double"))
            .when(t.rlike("^[+]?Infinity$"), F.lit(float("inf")))
            .when(t == "-Infinity", F.lit(float("-inf")))
            .when(t.rlike("^0[xX][0-9a-fA-F]+$"), based(16))
            .when(t.rlike("^0[oO][0-7]+$"), based(8))
            .when(t.rlike("^0[bB][01]+$"), based(2))
        )

    return let(trimmed(text), read)


def _digits(plain: Column) -> Column:
    """struct<digits, point> of Java's text of a positive number: 0.digits times ten to the point."""
    power = F.coalesce(F.split_part(plain, F.lit("E"), F.lit(2)).try_cast("int"), F.lit(0))
    mantissa = F.split_part(plain, F.lit("E"), F.lit(1))

    def split(p: Column) -> Column:
        whole, part = p["whole"], p["part"]
        small = whole == "0"
        digits = F.regexp_replace(F.when(small, F.regexp_replace(part, "^0+", "")).otherwise(F.concat(whole, part)), "0+$", "")
        return F.struct(digits.alias("digits"), (F.when(small, -F.length(F.regexp_extract(part, "^(0*)", 1))).otherwise(F.length(whole)) + p["power"]).alias("point"))

    part = F.regexp_replace(F.split_part(mantissa, F.lit("."), F.lit(2)), "^0$", "")
    return let(F.struct(F.split_part(mantissa, F.lit("."), F.lit(1)).alias("whole"), part.alias("part"), power.alias("power")), split)


def _shortest(x: Column) -> Column:
    """Java's text of a positive number; before JDK 19 it can be longer than need be, so 15 digits are taken where they give the same number."""
    text, short = x.cast("string"), F.regexp_replace(F.format_string("%.14e", x), "e[+]?", "E")
    return F.when((F.length(text) > 16) & (short.try_cast("double") == x), short).otherwise(text)


def number_text(value: Column) -> Column:
    """String(value): fixed digits below 1e21, no ".0", exponents as 1e+21."""

    def write(p: Column) -> Column:
        digits, point, n = p["digits"], p["point"], F.length(p["digits"])
        more = F.when(n > 1, F.concat(F.lit("."), F.substring(digits, 2, 400))).otherwise(F.lit(""))
        return (
            F.when(digits == "", F.lit("0"))
            .when((point > 21) | (point <= -6), F.concat(F.substring(digits, 1, 1), more, F.when(point > 0, F.lit("e+")).otherwise(F.lit("e-")), F.abs(point - 1).cast("string")))
            .when(point >= n, F.rpad(digits, point, "0"))
            .when(point > 0, F.concat(F.left(digits, point), F.lit("."), F.right(digits, n - point)))
            .otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        )

    def whole(x: Column) -> Column:
        sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
        text = let(_digits(_shortest(F.abs(x))), write)
        return F.when(F.isnan(x), F.lit("NaN")).when(F.abs(x) == float("inf"), F.concat(sign, F.lit("Infinity"))).otherwise(F.concat(sign, text))

    return let(value, whole)


def envelope(text: Column) -> Column:
    """Extended JSON text as struct<kind, str, num, ms>; kind is null for absent and null values."""
    wrapper = r'^\{\s*"\$number(Double|Int|Long|Decimal)"\s*:\s*"([^"]*)"\s*\}$'
    dated = r'^\{\s*"\$date"\s*:\s*\{\s*"\$numberLong"\s*:\s*"(-?[0-9]+)"\s*\}\s*\}$'

    def split(t: Column) -> Column:
        typed = t.startswith('{"$') | t.rlike(r'^\{\s+"\$')
        part = lambda pattern, group: F.when(typed, F.regexp_extract(t, pattern, group)).otherwise(F.lit(""))
        return let(F.struct(t.alias("t"), part(dated, 1).alias("date"), part(wrapper, 1).alias("wrapped"), part(wrapper, 2).alias("inside")), build)

    def build(p: Column) -> Column:
        t, date, wrapped, inside = (p[c] for c in ("t", "date", "wrapped", "inside"))
        quoted = t.startswith('"')
        kind = (
            F.when(t.isNull() | (t == "null"), F.lit(None).cast("string"))
            .when(quoted, "string")
            .when(t.isin("true", "false"), "boolean")
            .when(date != "", "date")
            .when(wrapped.isin("Double", "Int"), "number")
            .when(wrapped == "Long", "long")
            .when(wrapped == "Decimal", "decimal")
            .when(t.startswith("{"), "object")
            .when(t.startswith("["), "array")
            .otherwise("number")
        )
        # A quoted text without escapes is what stands between its quotes.
        read = F.when(~t.contains("\\") & t.endswith('"') & (F.length(t) > 1), F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(F.coalesce(F.get_json_object(F.concat(F.lit("["), t, F.lit("]")), "$[0]"), F.lit("")))
        string = F.when(quoted, read).when(wrapped != "", inside).otherwise(t)
        number = F.when(inside == "NaN", F.lit(float("nan"))).when(inside == "Infinity", F.lit(float("inf"))).when(inside == "-Infinity", F.lit(float("-inf"))).when(wrapped != "", inside.try_cast("double")).when(t.rlike("^-?[0-9]"), t.try_cast("double"))
        return F.struct(kind.alias("kind"), string.alias("str"), number.alias("num"), F.when(date != "", date.try_cast("long")).alias("ms"))

    return let(F.trim(text), split)


def as_string(v: Column) -> Column:
    """String(value), null where it is blank."""
    return let(v, _text_of)


def _text_of(v: Column) -> Column:
    kind = v["kind"]
    listed = F.array_join(F.from_json(v["str"], "array<string>"), ",", "")
    text = F.when(kind == "number", number_text(v["num"])).when(kind == "object", F.lit("[object Object]")).when(kind == "array", listed).when(kind == "date", format_time(v["ms"])).when(kind.isNotNull(), v["str"])
    return let(text, blank_to_null)


def _scaled(number: Column) -> Column:
    def scale(x: Column) -> Column:
        finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
        ms = F.when(x >= MILLIS_FROM, F.floor(x)).when(x >= SECONDS_FROM, F.floor(x * 1000))
        # What is larger than a long is clamped later anyway.
        return F.when(finite & (F.abs(x) < 9e18), ms).when(finite & (x > 0), F.lit(9 * 10**18)).cast("long")

    return let(number, scale)


def epoch_millis(v: Column) -> Column:
    """Milliseconds, null if the value is no time: dates as they are, numbers and numeric strings by magnitude."""
    return let(v, _millis_of)


def _millis_of(v: Column) -> Column:
    inner = F.get_json_object(v["str"], "$.$date")
    return F.when(v["kind"] == "date", v["ms"]).when(v["kind"] == "number", _scaled(v["num"])).when(v["kind"] == "string", _scaled(parse_number(v["str"]))).when((v["kind"] == "object") & inner.isNotNull(), _scaled(parse_number(inner)))


def cursor_millis(v: Column) -> Column:
    """epoch_millis without objects, 0 where there is none."""
    return F.coalesce(F.when(v["kind"] != "object", epoch_millis(v)), F.lit(0).cast("long"))


def clamp_time(ms: Column) -> Column:
    """Null stays null: least and greatest pass over it."""
    return F.when(ms.isNotNull(), F.least(F.greatest(ms, F.lit(TIME_MIN)), F.lit(TIME_MAX)))


def as_double(v: Column, default: float = 0.0) -> Column:
    number = F.when(v["kind"] == "number", v["num"]).when(v["kind"].isin("string", "long", "decimal"), parse_number(v["str"])).when(v["kind"] == "boolean", F.when(v["str"] == "true", 1.0).otherwise(0.0)).when(v["kind"] == "date", v["ms"].cast("double"))
    return let(number, lambda x: F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), x).otherwise(F.lit(default)))


def clamp_uint32(number: Column) -> Column:
    return F.least(F.greatest(F.floor(F.least(F.greatest(number, F.lit(-1.0)), F.lit(1e12))), F.lit(0)), F.lit(UINT32_MAX)).cast("long")


def is_plain_object(v: Column) -> Column:
    return v["kind"].isin("object", "long", "decimal")


def format_time(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss.SSS")


def month_of(time: Column) -> Column:
    return F.date_format(time, "yyyyMM")


def bucket(ms: Column, size: int) -> Column:
    """Start of ms's bucket; truncates as integer division does."""
    return (ms - ms % F.lit(size)).cast("long")


def short_hash(text: Column) -> Column:
    return F.substring(F.sha1(text), 1, 8)


def key_set(json: Column) -> Column:
    """An object's top-level keys, sorted and joined."""
    return F.array_join(F.array_sort(F.coalesce(F.json_object_keys(json), F.array().cast("array<string>"))), ",")


def half_up(number: Column) -> Column:
    return F.floor(number + 0.5)
