"""Event JSON: decode to typed columns with a reason for each bad record, and encode again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden import schemas
from tidewarden.config import (
    INCIDENT_TYPES,
    INSTITUTION_TYPES,
    PIPELINE_VERSION,
    TIERS,
    WireNames,
    UNTIERED_TOPIC,
)
from tidewarden.functions import jsontext, keys
from tidewarden.functions.plan import pinned

# Text forms that coerce to a value.
TRUE_TEXTS = ("1", "true", "t", "yes", "y", "on")
FALSE_TEXTS = ("0", "false", "f", "no", "n", "off")
UUID_TEXT = r"(?i)^(urn:uuid:)?([0-9a-f]{32}|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12})$"
USUAL_UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
INTEGER_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"
TIME_TEXT = (
    r"(?i)^\d{4}-\d{2}-\d{2}([t _]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?(z|[+-]\d{2}:?\d{2})?)?$"
)
USUAL_TIME = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d{1,6})?([+-]\d\d:\d\d|Z)?$"
# Above this a bare number is milliseconds, not seconds, since 1970.
LARGEST_SECONDS = 2e10
LARGEST_MILLIS = 2.5e14
BARE_NUMBERS = ('"NaN"', '"Infinity"', '"-Infinity"')

CORRUPT = "_corrupt"
# Any text is a valid value, so only the JSON type tells a string from a number or an object.
FREE_TEXT = ("institution_id", "ict_third_party_provider", "affected_systems")
DEFAULTED = ("incident_id", "incident_ts")
REQUIRED = tuple(f.name for f in schemas.INCIDENT.fields if not f.nullable)
ENRICHED = (
    "severity_label",
    "vendor_known",
    "vendor_type",
    "vendor_eu_headquartered",
    "vendor_designated_critical",
    "vendor_concentration_risk_score",
    "vendor_is_hyperscaler",
)
LITERALS = {
    "institution_type": INSTITUTION_TYPES,
    "incident_type": INCIDENT_TYPES,
    "severity": TIERS,
}


@dataclass(frozen=True)
class Node:
    """A JSON value: its text, and the value itself for the few texts that leave its type open.

    The text is decoded with the message. The value of most keys is parsed again, which is paid only
    by records where a column asks for it.
    """

    text: Column
    value: Column

    @property
    def kind(self) -> Column:
        return F.schema_of_variant(self.value)

    def get(self, kind: str) -> Column:
        return F.try_variant_get(self.value, "$", kind)


def _string(node: Node) -> Column:
    return F.when(node.kind == "STRING", node.text)


def _uuid(node: Node) -> Column:
    bare = F.regexp_replace(node.text, r"[{}]", "")
    digits = F.lower(F.replace(F.regexp_replace(bare, "(?i)^urn:uuid:", ""), F.lit("-")))
    shaped = F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    unusual = F.when(bare.rlike(UUID_TEXT) & (node.kind == "STRING"), shaped)
    return F.when(node.text.rlike(USUAL_UUID), node.text).otherwise(unusual)


def _number(node: Node) -> Column:
    from_flag = F.when(node.kind == "BOOLEAN", node.get("double"))
    return F.when(node.text.rlike(NUMBER_TEXT), F.trim(node.text).try_cast("double")).otherwise(from_flag)


def _integer(node: Node) -> Column:
    exact = _number(node).try_cast("decimal(20,6)")
    fits = (exact == F.floor(exact)) & (node.text.rlike(INTEGER_TEXT) | (node.kind != "STRING"))
    return F.when(fits, exact.try_cast("int"))


def _boolean(node: Node) -> Column:
    word = F.lower(node.text)
    from_number = F.when(
        node.text.rlike(NUMBER_TEXT) & (node.kind != "STRING"),
        F.when(node.get("double") == 1, True).when(node.get("double") == 0, False),
    )
    return (
        F.when(word.isin(*TRUE_TEXTS), True).when(word.isin(*FALSE_TEXTS), False).otherwise(from_number)
    )


def _timestamp(node: Node) -> Column:
    text = node.text
    # Reading a zone costs more than the rest; UTC is the session's zone and needs none.
    bare = F.left(text, F.length(text) - F.when(text.endswith("+00:00"), 6).when(text.endswith("Z"), 1).otherwise(0))
    # Otherwise Spark wants an upper-case zone, a blank between the parts, and a point in the fraction.
    spelled = F.translate(F.upper(text), "T_,", "  .")
    seconds = F.when(text.rlike(NUMBER_TEXT), F.trim(text).try_cast("double"))
    scale = F.when(F.abs(seconds) <= LARGEST_SECONDS, 1e6).otherwise(1e3)
    micros = F.rint(seconds * scale).try_cast("bigint")
    from_number = F.when(F.abs(seconds) < LARGEST_MILLIS, F.timestamp_micros(micros))
    return (
        F.when(text.rlike(USUAL_TIME), bare.try_cast("timestamp"))
        .when(text.rlike(TIME_TEXT), spelled.try_cast("timestamp"))
        .otherwise(from_number)
    )


def _string_list(node: Node) -> Column:
    items = node.get("array<variant>")
    all_text = F.forall(items, lambda v: F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False)))
    texts = F.transform(items, lambda v: F.try_variant_get(v, "$", "string"))
    return F.when(all_text, texts)


def _node_text(name: str, field: Column) -> Column:
    if name in FREE_TEXT:
        return F.try_variant_get(field, "$", "string")
    # Spark keeps bare NaN and Infinity in quotes.
    return F.when(field.isin(*BARE_NUMBERS), F.btrim(field, F.lit('"'))).otherwise(field)


def _parsed_again(key: str) -> Column:
    field = T.StructType([T.StructField(key, T.VariantType())])
    return F.from_json(F.col("value"), field, {"allowNonNumericNumbers": "true"}).getField(key)


def _coerced(name: str, kind: T.DataType, node: Node) -> Column:
    if name == "incident_id":
        return _uuid(node)
    if isinstance(kind, T.StringType):
        return _string(node)
    if isinstance(kind, T.TimestampType):
        return _timestamp(node)
    if isinstance(kind, T.DoubleType):
        return _number(node)
    if isinstance(kind, T.BooleanType):
        return _boolean(node)
    if isinstance(kind, T.IntegerType):
        return _integer(node)
    return _string_list(node)


def _typed(name: str, kind: T.DataType, node: Node) -> Column:
    if name in LITERALS:
        return node.text
    value = _coerced(name, kind, node)
    # An absent value needs no look at its type.
    return value if name in FREE_TEXT else F.when(node.text.isNotNull(), value)


def _any(conditions: list[Column]) -> Column:
    combined = conditions[0]
    for condition in conditions[1:]:
        combined = combined | condition
    return combined


def parse(raw: DataFrame, batch_ts: Column, names: WireNames = WireNames()) -> DataFrame:
    """Decode the JSON text in `value`: the fifteen typed columns, `value`, `processed_at`, `error_reason`.

    Coercion is lax where a producer's JSON usually varies (numbers and flags as text, epoch times),
    strict for text fields. `error_reason` is null for a good record, otherwise the first of
    json, missing, literal, type. Unknown keys are ignored, missing ids and times are filled in.
    """
    pairs = names.pairs()
    kinds = {f.name: f.dataType for f in schemas.INCIDENT.fields}
    wire = T.StructType(
        [T.StructField(key, T.VariantType() if name in FREE_TEXT else T.StringType()) for name, key in pairs]
        + [T.StructField(CORRUPT, T.StringType())]
    )
    text = F.col("value").cast("string")
    # The options also accept bare NaN and Infinity, which producers in some languages write.
    doc = F.from_json(text, wire, {"columnNameOfCorruptRecord": CORRUPT, "allowNonNumericNumbers": "true"})
    body = F.btrim(F.col("value"), F.lit(" \t\r\n"))
    whole = body.startswith("{") & body.endswith("}")
    broken = F.col("doc").isNull() | F.col("doc").getField(CORRUPT).isNotNull() | ~whole
    parsed = raw.select(text.alias("value"), batch_ts.alias("processed_at"), doc.alias("doc"))
    described = parsed.select(
        "value",
        "processed_at",
        F.coalesce(broken, F.lit(True)).alias("bad_json"),
        *[_node_text(name, F.col("doc").getField(key)).alias(f"text_{name}") for name, key in pairs],
        *[F.col("doc").getField(key).alias(f"node_{name}") for name, key in pairs if name in FREE_TEXT],
    )
    node = {
        name: Node(F.col(f"text_{name}"), F.col(f"node_{name}") if name in FREE_TEXT else _parsed_again(key))
        for name, key in pairs
    }
    given = {
        n: node[n].value.isNotNull() & ~F.is_variant_null(node[n].value) if n in FREE_TEXT else node[n].text.isNotNull()
        for n, _ in pairs
    }
    # A JSON null is an error for an id or a time; only a missing key gets the default.
    asked = {
        n: F.when(given[n], True).otherwise(
            F.coalesce(F.array_contains(F.json_object_keys("value"), key), F.lit(False))
        )
        if n in DEFAULTED
        else given[n]
        for n, key in pairs
    }
    typed = described.select(
        "value",
        "processed_at",
        "bad_json",
        _any([~given[n] for n in REQUIRED if n not in DEFAULTED]).alias("is_missing"),
        *[_typed(n, kinds[n], node[n]).alias(n) for n, _ in pairs],
        *[asked[n].alias(f"asked_{n}") for n, _ in pairs],
    )
    wrong_literal = _any(
        [
            F.col(f"asked_{n}") & ~F.coalesce(F.col(n).isin(*allowed), F.lit(False))
            for n, allowed in LITERALS.items()
        ]
    )
    wrong_type = _any([F.col(f"asked_{name}") & F.col(name).isNull() for name, _ in pairs])
    reason = (
        F.when(F.col("bad_json"), F.lit("json"))
        .when(F.col("is_missing"), F.lit("missing"))
        .when(wrong_literal, F.lit("literal"))
        .when(wrong_type, F.lit("type"))
    )
    filled = {
        "incident_id": F.coalesce(F.col("incident_id"), keys.uuid_of(F.col("value"))),
        "incident_ts": F.coalesce(F.col("incident_ts"), F.col("processed_at")),
    }
    return typed.select(
        *[filled.get(name, F.col(name)).alias(name) for name, _ in pairs],
        "value",
        "processed_at",
        # A filter on the reason must not pull a copy of the whole parse below it.
        pinned(reason).alias("error_reason"),
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error_reason").isNull()).select(*schemas.columns(schemas.INCIDENT))


def rejected_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error_reason").isNotNull()).select(*schemas.columns(schemas.REJECTED))


def decode(
    raw: DataFrame, batch_ts: Column, names: WireNames = WireNames()
) -> tuple[DataFrame, DataFrame]:
    """(good events, rejected records) of a frame of JSON text in `value`."""
    parsed = parse(raw, batch_ts, names)
    return good_rows(parsed), rejected_rows(parsed)


def encode(events: DataFrame, names: WireNames = WireNames()) -> DataFrame:
    """(key, value) messages: the institution, and the event as JSON with null fields kept."""
    return events.select(
        F.col("institution_id").alias("key"),
        jsontext.object_text(keys.event_members(names)).alias("value"),
    )


def enriched_messages(
    audited: DataFrame, topic: str, names: WireNames = WireNames()
) -> DataFrame:
    """(topic, key, value) messages: the classified event, its reason and its lineage.

    Expects the classified columns plus `processed_at` and `record_hash`. The columns that `enrich`
    adds are included where the frame has them.
    """
    text = T.StringType()
    kinds = {f.name: f.dataType for f in audited.schema.fields}
    members = keys.event_members(names) + [
        ("classification_reason", jsontext.value_text(F.col("classification_reason"), text)),
        ("processed_at", jsontext.value_text(F.col("processed_at"), T.TimestampType())),
        ("pipeline_version", jsontext.value_text(F.lit(PIPELINE_VERSION), text)),
        ("record_hash", jsontext.value_text(F.col("record_hash"), text)),
        *[(n, jsontext.value_text(F.col(n), kinds[n])) for n in ENRICHED if n in kinds],
    ]
    return audited.select(
        F.lit(topic).alias("topic"),
        F.col("institution_id").alias("key"),
        jsontext.object_text(members).alias("value"),
    )


def route(
    events: DataFrame, tier_topics: dict[str, str], names: WireNames = WireNames(), other_topic: str = UNTIERED_TOPIC
) -> DataFrame:
    """(topic, key, value) messages, the topic chosen by the tier the event carries.

    An event without a tier, or with one that has no topic, goes to `other_topic`: a message without a topic would
    fail its whole batch.
    """
    topic = F.lit(other_topic)
    for tier, name in tier_topics.items():
        topic = F.when(F.col("severity") == tier, F.lit(name)).otherwise(topic)
    return events.select(
        topic.alias("topic"),
        F.col("institution_id").alias("key"),
        jsontext.object_text(keys.event_members(names)).alias("value"),
    )
