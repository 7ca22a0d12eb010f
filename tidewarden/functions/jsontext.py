"""JSON text in one canonical spelling, so that hashes of it can be recomputed anywhere.

Separators are ", " and ": ", text is ASCII with lower-case \\uXXXX escapes, floats use the shortest
decimal form with a plain exponent range of 1e-4 to 1e16, timestamps are ISO 8601 with a UTC offset.
"""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters with a short escape in JSON text.
SHORT_ESCAPES = (
    ("\\", "\\\\"),
    ('"', '\\"'),
    ("\n", "\\n"),
    ("\r", "\\r"),
    ("\t", "\\t"),
    ("\b", "\\b"),
    ("\f", "\\f"),
)
# Printable ASCII without the quote and the backslash needs no escape at all.
PLAIN_TEXT = r"^[ !#-\[\]-~]*$"


def _short_escaped(text: Column) -> Column:
    for raw, escaped in SHORT_ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


def _unicode_escaped(text: Column) -> Column:
    """Replace each remaining UTF-16 unit outside printable ASCII by its \\uXXXX escape.

    The text is taken apart into runs of printable ASCII, which stay as they are, and single other characters.
    """
    pieces = F.regexp_extract_all(text, F.lit(r"[ -~]+|[^ -~]"), F.lit(0))
    spelled = F.transform(
        pieces,
        lambda p: F.when((p >= " ") & (p < "\x7f"), p).otherwise(
            F.regexp_replace(F.lower(F.hex(F.encode(p, "UTF-16BE"))), "(.{4})", r"\\u$1")
        ),
    )
    return F.array_join(spelled, "")


def quoted(text: Column) -> Column:
    """A string as a JSON string."""
    body = F.when(text.rlike(PLAIN_TEXT), text).otherwise(_unicode_escaped(_short_escaped(text)))
    return F.concat(F.lit('"'), body, F.lit('"'))


def float_text(value: Column) -> Column:
    """A double as a JSON number."""
    size = F.abs(value)
    digits = F.rtrim(value.cast("decimal(38,20)").cast("string"), F.lit("0"))
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    java = value.cast("string")
    mantissa = F.regexp_replace(F.regexp_extract(java, "^(.*)E", 1), r"\.0$", "")
    power = F.regexp_extract(java, "E-?([0-9]+)$", 1)
    exponent = F.concat(
        F.when(java.contains("E-"), F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.length(power) < 2, F.lpad(power, 2, "0")).otherwise(power),
    )
    return (
        F.when(F.isnan(value), F.lit("NaN"))
        .when(value == F.lit(float("inf")), F.lit("Infinity"))
        .when(value == F.lit(float("-inf")), F.lit("-Infinity"))
        .when((value == 0) | size.between(1e-3, 9_999_999.0), java)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.concat(mantissa, exponent))
    )


def iso_text(ts: Column) -> Column:
    """A timestamp as ISO 8601 in UTC, with microseconds only where they are not zero."""
    whole = F.pmod(F.unix_micros(ts), F.lit(1_000_000)) == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    )


def list_text(items: Column) -> Column:
    """An array of strings as a JSON array."""
    spelled = F.transform(items, lambda s: F.coalesce(quoted(s), F.lit("null")))
    return F.concat(F.lit("["), F.array_join(spelled, ", "), F.lit("]"))


def value_text(column: Column, kind: T.DataType) -> Column:
    """The JSON text of a column of the given type; a null value becomes `null`."""
    if isinstance(kind, T.StringType):
        text = quoted(column)
    elif isinstance(kind, T.ArrayType):
        text = list_text(column)
    elif isinstance(kind, T.DoubleType):
        text = float_text(column)
    elif isinstance(kind, T.TimestampType):
        text = F.concat(F.lit('"'), iso_text(column), F.lit('"'))
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit("null"))


def object_text(members: Iterable[tuple[str, Column]]) -> Column:
    """A JSON object from (key, JSON text) pairs; the keys are plain ASCII names."""
    parts: list[Column] = []
    for n, (key, text) in enumerate(members):
        parts += [F.lit(f'{"" if n == 0 else ", "}"{key}": '), text]
    return F.concat(F.lit("{"), *parts, F.lit("}"))
