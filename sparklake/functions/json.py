"""Payload decoding helpers: base64 -> JSON text -> typed struct, no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklake.functions.scalar import col

# Every field is read as text: a JSON number in a text field keeps its digits
# (``12`` -> ``"12"``), as the item store keeps ids and amounts as strings.
ORDER_EVENT_FIELDS = ("event_id", "order_id", "customer_id", "event_type", "product",
                      "amount", "status", "timestamp")
ORDER_EVENT_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in ORDER_EVENT_FIELDS])
REQUIRED_FIELDS = ("event_id", "order_id", "customer_id", "event_type", "status", "timestamp")
OPTIONAL_DEFAULTS = {"product": "", "amount": "0"}


def decode_base64_text(c) -> Column:
    """base64 text -> UTF-8 text; malformed base64 gives NULL (not an empty string)."""
    return F.try_to_binary(col(c), F.lit("base64")).cast("string")


def json_map(text) -> Column:
    """Parse a JSON object once into ``map<string,string>``: scalar values keep
    their text (``12`` -> ``"12"``), a key present with JSON null stays in the
    map, a repeated key keeps its last value, and text that is not a JSON object
    gives a NULL map."""
    parsed = F.from_json(col(text), "map<string,string>")
    keys = F.map_keys(parsed)
    last = F.aggregate(
        F.map_entries(parsed), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")),
        lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["key"]), F.map_from_entries(F.array(e))))
    return F.when(F.size(keys) == F.size(F.array_distinct(keys)), parsed).otherwise(last)


def field_or_default(parsed: Column, name: str, default: str) -> Column:
    """A missing key takes the default; a key present with JSON null stays NULL;
    a payload that is not a JSON object gives NULL (no default)."""
    return (F.when(parsed.isNull(), F.lit(None).cast("string"))
             .when(F.map_contains_key(parsed, F.lit(name)), parsed[name])
             .otherwise(F.lit(default)))
