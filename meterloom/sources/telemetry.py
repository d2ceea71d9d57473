"""Telemetry log batches (OTLP/JSON) to one row per usage event."""

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from meterloom import schemas
from meterloom.fixed_values import EVENT_PREFIX, TELEMETRY_SOURCE, USAGE_EVENTS
from meterloom.functions.numbers import number
from meterloom.functions.text import session_or_null
from meterloom.functions.times import epoch_seconds, iso
from meterloom.sources.lines import computed, parsed


def plain_value(value: Column) -> Column:
    """One wrapped scalar ({"stringValue": …}, {"intValue": "10"}, …) as plain JSON text."""
    flat = (F.when(value["stringValue"].isNotNull(), _quoted(value["stringValue"]))
            .when(value["intValue"].isNotNull(), value["intValue"].try_cast("long").cast("string"))
            .when(value["doubleValue"].isNotNull(), value["doubleValue"].cast("string"))
            .when(value["boolValue"].isNotNull(), value["boolValue"].cast("string")))
    return F.coalesce(flat, F.lit("null"))


def _unwrapped(value: dict | None):
    """A wrapped value, lists within lists to any depth, as the value it stands for."""
    value = value or {}
    if value.get("stringValue") is not None:
        return value["stringValue"]
    if value.get("intValue") is not None:
        text = str(value["intValue"]).strip()
        return int(text) if re.fullmatch(r"[+-]?\d+", text) and -2**63 <= int(text) < 2**63 else None
    for name in ("doubleValue", "boolValue"):
        if value.get(name) is not None:
            return value[name]
    if value.get("arrayValue") is not None:
        return [_unwrapped(v) for v in value["arrayValue"].get("values") or ()]
    if value.get("kvlistValue") is not None:
        return {p.get("key"): _unwrapped(p.get("value")) for p in value["kvlistValue"].get("values") or ()}
    return None


@F.pandas_udf(T.StringType())
def _nested_object(lists: pd.Series) -> pd.Series:
    """Attribute lists, as JSON text, to JSON objects. Only lists that hold arrays or lists come here: expressions cannot
    follow values of any depth."""
    return lists.map(lambda text: None if text is None else json.dumps(
        {p.get("key"): _unwrapped(p.get("value")) for p in json.loads(text)}, separators=(",", ":"), ensure_ascii=False))


def _quoted(text: Column) -> Column:
    """A JSON string; the serialiser is asked only where something needs escaping."""
    json = F.to_json(F.struct(text.alias("v")))
    return F.when(text.rlike(r'["\\\x00-\x1f]'), F.substring(json, F.lit(6), F.length(json) - 6)).otherwise(
        F.concat(F.lit('"'), text, F.lit('"')))


def plain_object(pairs: Column) -> Column:
    """Attribute list to a JSON object text."""
    flat = F.concat(F.lit("{"), F.coalesce(F.array_join(F.transform(pairs, lambda p: F.concat(
        _quoted(p["key"]), F.lit(":"), plain_value(p["value"]))), ","), F.lit("")), F.lit("}"))
    nested = F.exists(pairs, lambda p: p["value"]["arrayValue"].isNotNull() | p["value"]["kvlistValue"].isNotNull())
    return F.coalesce(_nested_object(F.when(nested, F.to_json(pairs))), flat)


def _attribute(name: str, kind: str) -> Column:
    """A scalar of the attribute list, found by its key's place in `keys`, the list's keys from the end (the last one,
    should a key come twice); no object or list is built and no lambda runs for it."""
    from_end = F.array_position("keys", name).cast("int")
    value = F.get("attributes", F.when(from_end > 0, F.size("attributes") - from_end))["value"]
    if kind == "string":
        return value["stringValue"]
    whole, real = value["intValue"].try_cast("long"), value["doubleValue"]
    return F.coalesce(whole, real.try_cast("long")) if kind == "long" else F.coalesce(whole.cast("double"), real)


def usage_events(batches: DataFrame, value: str = "value", received: str = "received_ts") -> DataFrame:
    """One row per usage event of the batches; every other event is dropped when its name is known. `keys`: the attributes'
    keys from the end, listed once."""
    j = parsed(batches.withColumn("received_ts", F.col(received).cast("long")), schemas.OTLP_BATCH, "received_ts", value=value)
    r = j.select("received_ts", F.explode("resourceLogs").alias("r"))
    s = r.select("received_ts", F.col("r.resource.attributes").alias("resource"), F.explode("r.scopeLogs").alias("s"))
    e = s.select("received_ts", "resource", F.explode("s.logRecords").alias("e"))
    rec = e.select("received_ts", "resource", F.col("e.attributes").alias("attributes"), F.col("e.body.stringValue").alias("body"),
                   F.coalesce(F.col("e.timeUnixNano").try_cast("long"), F.lit(0)).alias("time_unix_nano"))
    named = computed(computed(rec, keys=F.reverse(F.col("attributes.key"))), _name=_attribute("event.name", "string"))
    name = F.when(F.col("_name") != "", F.col("_name")).otherwise(F.coalesce("body", F.lit("")))
    prefix = EVENT_PREFIX.replace(".", "[.]")
    return computed(named, event=F.regexp_replace(name, f"^{prefix}", "")).where(F.col("event").isin(USAGE_EVENTS))


def telemetry(batches: DataFrame, value: str = "value", received: str = "received_ts") -> DataFrame:
    """Usage events in the telemetry table's columns (no arrival number), the flattened event kept in `raw`."""
    texts, counts = ("request_id", "model", "query_source"), ("input_tokens", "output_tokens", "cache_read_tokens", "cache_creation_tokens")
    rows = computed(usage_events(batches, value, received), ts=F.expr("time_unix_nano div 1000000000"), _session=_attribute("session.id", "string"),
                    **{c: _attribute(c, "string") for c in texts}, **{c: _attribute(c, "long") for c in counts},
                    cost_usd=_attribute("cost_usd", "double"), _attributes=plain_object(F.col("attributes")),
                    _resource=plain_object(F.col("resource")))
    raw = F.concat(
        F.lit('{"source":"' + TELEMETRY_SOURCE + '","observed_at":'), F.col("ts").cast("string"),
        F.lit(',"received_at":'), F.coalesce(F.col("received_ts").cast("string"), F.lit("null")),
        F.lit(',"event":"'), F.col("event"), F.lit('","time_unix_nano":'), F.col("time_unix_nano").cast("string"),
        F.lit(',"attributes":'), F.col("_attributes"), F.lit(',"resource":'), F.col("_resource"), F.lit("}"))
    return rows.select("ts", iso(F.col("ts")).alias("dt"), "event", session_or_null(F.col("_session")).alias("session_id"), *texts, *counts,
                       "cost_usd", "received_ts", raw.alias("raw"))


def telemetry_from_lines(lines: DataFrame) -> DataFrame:
    """Already flattened telemetry lines (JSON objects with an `attributes` object) in the table's columns. A number is
    taken only where the JSON holds one."""
    j = parsed(lines, schemas.TELEMETRY_LINE, *[c for c in lines.columns])
    at = number(F.col("observed_at"), "long")
    dated = j.where((F.col("source") == TELEMETRY_SOURCE) & F.col("attributes").isNotNull()).select(
        *lines.columns, F.coalesce(at, epoch_seconds(F.try_variant_get("observed_at", "$", "string"))).alias("ts"), "event", "attributes",
        number(F.col("received_at"), "long").alias("received_ts"))
    a = F.col("attributes")
    num = lambda name, kind: number(a[name], kind).alias(name)
    return dated.where(F.col("ts").isNotNull()).select(
        *[c for c in lines.columns if c != "value"], "ts", iso(F.col("ts")).alias("dt"), "event",
        session_or_null(a["session.id"]).alias("session_id"), a["request_id"].alias("request_id"), a["model"].alias("model"),
        a["query_source"].alias("query_source"),
        *[num(c, "long") for c in ("input_tokens", "output_tokens", "cache_read_tokens", "cache_creation_tokens")],
        num("cost_usd", "double"), "received_ts", F.col("value").alias("raw"))
