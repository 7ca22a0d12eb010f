"""Keys and digests."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden import schemas
from tidewarden.config import WireNames
from tidewarden.functions import jsontext

# Fixed value: the marker that stands for null in a surrogate key.
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the parts joined by '-'."""
    texts = [F.coalesce(p.cast("string"), F.lit(NULL_KEY)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def uuid_of(text: Column) -> Column:
    """A UUID-shaped id that is the same on every replay of the same text."""
    return F.regexp_replace(
        F.md5(text), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )


def event_members(names: WireNames = WireNames()) -> list[tuple[str, Column]]:
    """(key, JSON text) of the fifteen event fields in schema order."""
    kinds = {f.name: f.dataType for f in schemas.INCIDENT.fields}
    return [(key, jsontext.value_text(F.col(name), kinds[name])) for name, key in names.pairs()]


def record_hash(names: WireNames = WireNames()) -> Column:
    """SHA-256 of the fifteen classified fields as canonical JSON with sorted keys."""
    return F.sha2(jsontext.object_text(sorted(event_members(names), key=lambda m: m[0])), 256)


def event_digest() -> Column:
    """SHA-256 that tells events apart by their fifteen fields; cheaper than `record_hash`, and not for storing."""
    fields = [
        (F.unix_micros(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)).alias(f.name)
        for f in schemas.INCIDENT.fields
    ]
    # Plain JSON leaves null fields out and quotes NaN and Infinity, so it differs wherever a field does.
    return F.sha2(F.to_json(F.struct(*fields)), 256)
