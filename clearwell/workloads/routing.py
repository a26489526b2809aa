"""Routing of upload notifications derived from the web pages."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.operators import routing
from clearwell.workloads.registry import Tables, query
from clearwell.workloads.shapes import pick, sql_pick

_BUCKET = "landing"
_DAY = datetime(2024, 3, 5, 7, 30, tzinfo=UTC)
_RUN = "run-1"
# Ends of file names as a notification encodes them, and as they are meant.
_ENCODED = (".csv", ".JSON", ".jsonl", ".parquet", ".csv.gz", ".xlsx", ".gz", "", "+a%20b.CSV", "%zz%41.json", ".parquet.gz")
_DECODED = (".csv", ".JSON", ".jsonl", ".parquet", ".csv.gz", ".xlsx", ".gz", "", " a b.CSV", "%zzA.json", ".parquet.gz")


def notifications(t: Tables) -> DataFrame:
    """A JSON message per page, with two uploads each; every 13th has none."""
    page = F.col("page_id")
    host = F.regexp_extract("url", "//([^/]+)", 1)
    size = F.when(page % 7 == 3, 0).otherwise(F.length("html")).cast("bigint")
    first = F.concat(F.lit("uploads/"), page.cast("string"), F.lit("+"), host, pick(page % len(_ENCODED), _ENCODED))
    second = F.concat(F.lit("logs/"), F.floor(page / 2).cast("string"), F.lit(".csv"))

    def record(key, length):
        upload = F.struct(key.alias("key"), length.alias("size"))
        bucket = F.struct(F.lit(_BUCKET).alias("name"))
        return F.struct(F.struct(bucket.alias("bucket"), upload.alias("object")).alias("s3"))

    # Every third message leaves out the size of its second upload.
    records = F.array(record(first, size), record(second, F.when(page % 3 != 0, size + 1)))
    message = F.struct(F.when(page % 13 != 0, records).alias("Records"))
    return t["pages"].select(F.to_json(message).alias("value"))


_SQL_UPLOADS = f"""
    records AS (
        SELECT unnest(CASE WHEN page_id % 13 = 0 THEN [] ELSE [
            {{'key': 'uploads/' || page_id || ' ' || regexp_extract(url, '//([^/]+)', 1)
                || {sql_pick(f"page_id % {len(_DECODED)}", _DECODED)},
              'size': CASE WHEN page_id % 7 = 3 THEN 0 ELSE length(html) END}},
            {{'key': 'logs/' || CAST(page_id // 2 AS VARCHAR) || '.csv',
              'size': CASE WHEN page_id % 3 = 0 THEN 0 WHEN page_id % 7 = 3 THEN 1 ELSE length(html) + 1 END}}
        ] END) AS r
        FROM pages
    ),
    uploads AS (SELECT '{_BUCKET}' AS bucket, r.size AS size, r.key AS original_key FROM records)"""
_EXTENSION = r"^\.*[^.].*?(\.[^.]*)$"
_SQL_VERDICTS = f"""
    {_SQL_UPLOADS},
    named AS (SELECT *, split_part(original_key, '/', -1) AS file FROM uploads),
    endings AS (
        SELECT *, regexp_extract(lower(file), '{_EXTENSION}', 1) AS ending,
            regexp_extract(regexp_replace(lower(file), '\\.gz$', ''), '{_EXTENSION}', 1) AS inner_ending
        FROM named
    ),
    kinds AS (
        SELECT *, CASE WHEN ending = '.gz' AND inner_ending = '.parquet' THEN '' WHEN ending = '.gz' THEN inner_ending
                       ELSE ending END AS kind
        FROM endings
    ),
    judged AS (
        SELECT *,
            CASE WHEN ending NOT IN ('.csv', '.json', '.jsonl', '.parquet', '.gz') THEN 'unsupported_extension'
                 WHEN size = 0 THEN 'empty_file'
                 WHEN kind NOT IN ('.csv', '.json', '.jsonl', '.parquet') THEN 'unknown_format' END AS reason
        FROM kinds
    ),
    verdicts AS (
        SELECT bucket, size, original_key, CASE WHEN reason IS NULL THEN 'triggered' ELSE 'skipped' END AS status,
            reason, CASE WHEN reason IS NULL THEN replace(substr(kind, 2), 'jsonl', 'json') END AS format,
            CASE WHEN reason IS NULL THEN substr(kind, 2) END AS reader,
            CASE WHEN reason IS NULL THEN 'raw/' || replace(substr(kind, 2), 'jsonl', 'json')
                || '/year=2024/month=03/day=05/' || file END AS organized_key,
            CASE WHEN reason IS NULL THEN '{_RUN}' END AS run_id
        FROM judged
    )"""


def _uploads(t: Tables) -> DataFrame:
    return routing.decode_keys(routing.read_notifications(notifications(t))).drop("malformed")


_SQL_ODD = """
    SELECT CASE page_id % 4 WHEN 0 THEN 'no JSON ' || page_id WHEN 1 THEN '[' || page_id || ']'
        WHEN 2 THEN '{"Records": [{"s3": {"object": {"size": ' || page_id || '}}}]}' ELSE '{"page": 1}' END AS value
    FROM pages"""


@query(f"""
    SELECT 'skipped' AS status, 'malformed_notification' AS reason, value AS malformed, count(*) AS files
    FROM ({_SQL_ODD}) WHERE value <> '{{"page": 1}}' GROUP BY value
""")
def malformed_notifications(t: Tables) -> DataFrame:
    """Messages that are no notifications, and records without a key, have verdicts of their own."""
    page = F.col("page_id")
    text = page.cast("string")
    odd = (
        F.when(page % 4 == 0, F.concat(F.lit("no JSON "), text))
        .when(page % 4 == 1, F.concat(F.lit("["), text, F.lit("]")))
        .when(page % 4 == 2, F.concat(F.lit('{"Records": [{"s3": {"object": {"size": '), text, F.lit("}}}]}")))
        .otherwise('{"page": 1}')
    )
    uploads = routing.decode_keys(routing.read_notifications(t["pages"].select(odd.alias("value"))))
    verdicts = routing.route(uploads, _DAY, _RUN)
    return verdicts.groupBy("status", "reason", "malformed").agg(F.count(F.lit(1)).alias("files"))


def _verdicts(t: Tables) -> DataFrame:
    return routing.route(_uploads(t), _DAY, _RUN)


@query(f"WITH {_SQL_UPLOADS} SELECT bucket, size, original_key FROM uploads")
def notification_records(t: Tables) -> DataFrame:
    return _uploads(t)


@query(f"WITH {_SQL_UPLOADS} SELECT * FROM uploads WHERE original_key LIKE 'uploads/%'")
def uploads_under_prefix(t: Tables) -> DataFrame:
    return routing.under_prefix(_uploads(t))


@query(f"WITH {_SQL_VERDICTS} SELECT * FROM verdicts")
def route_uploads(t: Tables) -> DataFrame:
    return _verdicts(t)


@query(f"""
    WITH {_SQL_VERDICTS} SELECT status, reason, format, count(*) AS files FROM verdicts GROUP BY ALL
""")
def routing_summary(t: Tables) -> DataFrame:
    return routing.routing_summary(_verdicts(t))


@query(f"""
    WITH {_SQL_VERDICTS}
    SELECT organized_key, count(*) AS uploads FROM verdicts WHERE status = 'triggered'
    GROUP BY organized_key HAVING count(*) > 1
""")
def raw_key_collisions(t: Tables) -> DataFrame:
    return routing.raw_key_collisions(_verdicts(t))
