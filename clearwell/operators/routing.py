"""Upload notifications to routing verdicts, as column expressions."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.functions.keys import (
    SUPPORTED_EXTENSIONS,
    UNKNOWN,
    data_extension,
    decoded_key,
    extension,
    format_of,
    raw_key,
    reader_of,
)

# Fixed value: the part of an upload notification the routing looks at.
NOTIFICATION = (
    "Records array<struct<s3: struct<bucket: struct<name: string>,"
    " object: struct<key: string, size: bigint>>>>"
)

TRIGGERED, SKIPPED = "triggered", "skipped"
MALFORMED = "malformed_notification"


def read_notifications(messages: DataFrame, body: str = "value") -> DataFrame:
    """One row per uploaded file of a table of JSON notifications.

    A message with an empty list of records gives no row; a record without a size has
    size 0. A message that does not parse, a null one, and a record without a key
    give one row, with the message as ``malformed`` and nothing else.
    """
    parsed = messages.select(F.col(body).alias("message"), F.from_json(F.col(body), NOTIFICATION).alias("n"))
    # A document that is no object, or whose records are no list, parses to nothing.
    sound = F.col("n.Records").isNotNull() | F.coalesce(F.get_json_object("message", "$").startswith("{"), F.lit(False))
    sound &= F.col("n.Records").isNotNull() | F.get_json_object("message", "$.Records").isNull()
    entries = F.when(sound, F.coalesce("n.Records", F.array())).otherwise(F.array(F.lit(None)))
    files = parsed.select("message", F.explode(entries).alias("r"))
    key = F.col("r.s3.object.key")
    return files.select(
        F.col("r.s3.bucket.name").alias("bucket"),
        key.alias("encoded_key"),
        F.coalesce(F.col("r.s3.object.size"), F.lit(0)).cast("bigint").alias("size"),
        F.when(key.isNull(), F.coalesce("message", F.lit(""))).alias("malformed"),
    )


def decode_keys(uploads: DataFrame) -> DataFrame:
    """Replace ``encoded_key`` by the readable ``original_key``."""
    others = [name for name in uploads.columns if name != "encoded_key"]
    return uploads.select(*others, decoded_key(F.col("encoded_key")).alias("original_key"))


def under_prefix(uploads: DataFrame, prefix: str = "uploads/") -> DataFrame:
    """Only files below the folder that announces uploads."""
    return uploads.filter(F.startswith(F.col("original_key"), F.lit(prefix)))


def route(uploads: DataFrame, ingest_ts: datetime | None = None, batch_id: str | None = None) -> DataFrame:
    """A verdict for every file, skipped ones with the reason.

    ``uploads`` has ``original_key`` and ``size``; an upload without a key comes from a
    malformed notification. The extension is judged before the size. The place in the raw zone, the format, the reader and the batch are
    set on accepted files only. Files of one day that share a name share their
    place in the raw zone; ``raw_key_collisions`` lists those.
    """
    key = F.col("original_key")
    day = F.lit(ingest_ts or datetime.now(UTC))
    # Each stage is used several times by the next, so it stays a column of its own.
    endings = uploads.withColumns(
        {"_outer": F.coalesce(extension(key), F.lit("")), "_inner": F.coalesce(data_extension(key), F.lit(""))}
    )
    judged = endings.withColumns(
        {
            "format": format_of(F.col("_inner")),
            "reader": reader_of(F.col("_inner")),
            "reason": F.when(key.isNull(), MALFORMED)
            .when(~F.col("_outer").isin(*SUPPORTED_EXTENSIONS), "unsupported_extension")
            .when(F.col("size") == 0, "empty_file")
            .when(format_of(F.col("_inner")) == UNKNOWN, "unknown_format"),
        }
    )
    accepted = F.col("reason").isNull()
    return judged.select(
        *uploads.columns,
        F.when(accepted, TRIGGERED).otherwise(SKIPPED).alias("status"),
        "reason",
        F.when(accepted, F.col("format")).alias("format"),
        F.when(accepted, F.col("reader")).alias("reader"),
        F.when(accepted, raw_key(key, F.col("format"), day)).alias("organized_key"),
        F.when(accepted, F.lit(batch_id).cast("string")).alias("run_id"),
    )


def routing_summary(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("status", "reason", "format").agg(F.count(F.lit(1)).alias("files"))


def raw_key_collisions(verdicts: DataFrame) -> DataFrame:
    """Places in the raw zone that more than one accepted upload would take."""
    return (
        verdicts.filter(F.col("status") == TRIGGERED)
        .groupBy("organized_key")
        .agg(F.count(F.lit(1)).alias("uploads"))
        .filter(F.col("uploads") > 1)
    )
