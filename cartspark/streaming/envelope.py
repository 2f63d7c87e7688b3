"""Records as they travel on the wire: base64 of UTF-8 of a JSON object, many to an envelope.

A record that cannot be decoded is kept with the reason, so that it can be counted and put aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartspark.functions import json_list, to_long
from cartspark.sources.events import EVENT_SCHEMA

# Reasons of failure.
NO_DATA = "no data"
BAD_BASE64 = "bad base64"
BAD_UTF8 = "bad utf-8"
BAD_JSON = "bad json"
NOT_AN_OBJECT = "not an object"

# Whole groups of base64, and then one that padding completes. A sign that completes nothing is passed over.
LENIENT = "^((?:=*[^=]=*[^=]=?[^=][^=])*)(=*[^=]=*[^=](?:==|=?[^=]=))?"


def decode_envelope(envelopes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode every record of ``Records: array<struct<kinesis: struct<data: string>>>``.

    ``keep`` names columns of the envelope, such as its id, to carry along. An envelope without records is one row
    whose ``record_number`` is null, so that it still has an estimate.
    """
    records = envelopes.select(*keep, F.posexplode_outer("Records").alias("record_number", "record"))
    data = records.select(*keep, "record_number", F.col("record.kinesis.data").alias("data"))
    decoded = decode_records(data, (*keep, "record_number"))
    there = F.col("record_number").isNotNull()
    return decoded.withColumn("failure_reason", F.when(there, F.col("failure_reason")))


def decode_records(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode the base64 column ``data`` into the event columns; ``failure_reason`` is null for a good record.

    Base64 is read as lenient readers do: other ASCII characters are skipped, text behind a complete padding is
    ignored and surplus padding is allowed, but missing padding and characters beyond ASCII are failures.
    """
    plain = F.regexp_replace("data", "[^A-Za-z0-9+/=]", "")
    # Letters up to the first padding that completes a group of four; what is behind it is ignored.
    simple = F.col("letters").rlike("^[^=]*=*$")
    padded = ~simple & (F.regexp_extract("letters", LENIENT, 2) != "")
    read = F.when(padded, F.regexp_extract("letters", LENIENT, 0)).otherwise(F.col("letters"))
    missing = F.pmod(-F.length("body"), F.lit(4))
    signs = F.length("letters") - F.length("body")
    complete = (missing == 0) | padded | (simple & (missing < 3) & (signs >= missing))
    ascii_only = F.length("data") == F.octet_length("data")
    decoded = (
        records.select(*keep, "data")
        .withColumn("letters", F.when(ascii_only, plain))
        .withColumn("body", F.replace(read, F.lit("="), F.lit("")))
        .withColumn("whole", F.when(complete, F.concat("body", F.repeat(F.lit("="), missing))))
        .withColumn("text", F.try_to_binary("whole", F.lit("base64")).cast("string"))
    )
    reason = F.when(F.col("data").isNull(), NO_DATA).when(F.col("text").isNull(), BAD_BASE64)
    return decode_text(decoded, (*keep, "data"), reason)


def decode_values(values: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode the JSON text column ``value``, as a topic or a file of JSON lines has it; the text is kept as ``data``."""
    text = values.select(*keep, F.col("value").alias("data"), F.col("value").alias("text"))
    return decode_text(text, (*keep, "data"), F.when(F.col("text").isNull(), NO_DATA))


def decode_text(records: DataFrame, keep: tuple[str, ...], reason: Column) -> DataFrame:
    """Read the JSON column ``text`` into the event columns. ``reason`` tells why it may be missing.

    A record is one JSON object and nothing else. Of a repeated field the last counts, NaN is a number that is none,
    and a field that does not fit its column is null in a good record.
    """
    fields = ", ".join(f"{name} string" for name in EVENT_SCHEMA.names)
    listed = json_list(F.col("valid_text"), fields)
    parsed = (
        records.withColumn("valid_text", F.try_validate_utf8("text"))
        .withColumn("objects", listed)
        .withColumn("fits", F.coalesce(F.size("objects") == 1, F.lit(False)))
        .withColumn("is_object", F.col("valid_text").rlike(r"^[ \t\r\n]*\{"))
        # Other JSON values are read on their own; they are no events.
        .withColumn("is_json", F.col("fits") | F.try_parse_json("valid_text").isNotNull())
    )
    why = (
        F.when(reason.isNotNull(), reason)
        .when(F.col("valid_text").isNull(), BAD_UTF8)
        .when(F.col("is_object") & ~F.col("fits"), BAD_JSON)
        .when(~F.col("is_json"), BAD_JSON)
        .when(~F.col("is_object"), NOT_AN_OBJECT)
    )
    cells = []
    for field in EVENT_SCHEMA:
        cell = F.col("objects")[0][field.name]
        is_text = isinstance(field.dataType, T.StringType)
        cells.append(F.when(why.isNull(), cell if is_text else to_long(cell, T.StringType())).alias(field.name))
    return parsed.select(*keep, *cells, why.alias("failure_reason"))


def good_events(decoded: DataFrame) -> DataFrame:
    good = decoded.filter(F.col("failure_reason").isNull())
    if "record_number" in decoded.columns:
        good = good.filter(F.col("record_number").isNotNull())
    return good.select(*EVENT_SCHEMA.names)


def failed_records(decoded: DataFrame) -> DataFrame:
    """The dead letters: what came in, and why it could not be used."""
    return decoded.filter(F.col("failure_reason").isNotNull()).select("data", "failure_reason")
