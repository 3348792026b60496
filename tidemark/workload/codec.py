"""PRJ queries."""

from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark.functions import METADATA_READ_RULES, METADATA_WRITE_RULES, format_time
from tidemark.workload.logs import EV_LOG, event_log, supplied
from tidemark.workload.registry import query

ISO = "'%Y-%m-%dT%H:%M:%S.%f'"

PAYLOAD = f"""'{{"stream_id":' || to_json(stream_id) || ',"offset":' || offset_json
    || ',"metadata":' || metadata || ',"created_at":"' || strftime(created_at, {ISO})
    || '","updated_at":"' || strftime(updated_at, {ISO}) || '"'"""


@query("prj1_encode_payloads", f"""WITH {EV_LOG}
SELECT pipeline_id, seq, {PAYLOAD} || '}}' AS data FROM ev_log""")
def _(spark, sf_dir):
    return ops.encode_payloads(event_log(spark, sf_dir)).select("pipeline_id", "seq", "data")


def _payloads(spark, sf_dir):
    """Payloads of which every seventh is cut short and every fifth has no metadata."""
    encoded = ops.encode_payloads(event_log(spark, sf_dir)).select("pipeline_id", "seq", "data")
    data = F.when(
        F.col("seq") % 7 == 0, F.substring("data", F.lit(1), F.length("data") - 5)
    ).when(F.col("seq") % 5 == 0, F.regexp_replace("data", '"metadata":[^}]*},', ""))
    return encoded.withColumn("data", F.coalesce(data, F.col("data")))


@query("prj2_decode_good", f"""WITH {EV_LOG}
SELECT pipeline_id, seq, stream_id, offset_json, offset_num,
       CASE WHEN seq % 5 = 0 THEN '{{}}' ELSE replace(metadata, ' ', '') END AS metadata,
       created_at, updated_at
FROM ev_log WHERE seq % 7 <> 0""")
def _(spark, sf_dir):
    good, _ = ops.decode_payloads(_payloads(spark, sf_dir))
    return good.drop("expires_at")


@query("prj2_decode_bad", f"""WITH {EV_LOG}, payloads AS (
    SELECT pipeline_id, seq, {PAYLOAD} || '}}' AS data FROM ev_log)
SELECT pipeline_id, seq, left(data, length(data) - 5) AS data FROM payloads WHERE seq % 7 = 0""")
def _(spark, sf_dir):
    _, bad = ops.decode_payloads(_payloads(spark, sf_dir))
    return bad


@query("prj2_decode_bytes", f"""WITH {EV_LOG}
SELECT pipeline_id, seq, stream_id, offset_num FROM ev_log""")
def _(spark, sf_dir):
    encoded = ops.encode_payloads(event_log(spark, sf_dir)).select(
        "pipeline_id", "seq", F.encode("data", "UTF-8").alias("data")
    )
    good, _ = ops.decode_payloads(encoded)
    return good.select("pipeline_id", "seq", "stream_id", "offset_num")


@query("prj3_normalise_offsets_json", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(event_id AS VARCHAR)
                  WHEN 1 THEN '"' || event_id || '"'
                  WHEN 2 THEN '{"partition":0,"pos":' || event_id || '}'
                  ELSE event_id || '.5' END AS offset_json,
       CASE WHEN event_id % 4 = 0 THEN event_id END AS offset_num
FROM events""")
def _(spark, sf_dir):
    number = F.col("event_id").cast("string")
    offset = (
        F.when(F.col("event_id") % 4 == 0, number)
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit('"'), number, F.lit('"')))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit('{"partition":0,"pos":'), number, F.lit("}")))
        .otherwise(F.concat(number, F.lit(".5")))
    )
    events = supplied(spark, sf_dir, "events").select("event_id", offset.alias("offset"))
    return ops.normalise_offsets(events, "json")


@query("prj3_normalise_offsets_text", """
SELECT event_id, '"' || event_type || '-' || event_id || '"' AS offset_json,
       CAST(NULL AS BIGINT) AS offset_num FROM events""")
def _(spark, sf_dir):
    events = supplied(spark, sf_dir, "events").select(
        "event_id", F.concat_ws("-", "event_type", "event_id").alias("offset")
    )
    return ops.normalise_offsets(events, "text")


@query("prj3_normalise_offsets_int", """
SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN CAST(event_id AS VARCHAR) END AS offset_json,
       CASE WHEN event_id % 3 <> 0 THEN event_id END AS offset_num FROM events""")
def _(spark, sf_dir):
    digits = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(
        F.col("event_id").cast("string")
    )
    events = supplied(spark, sf_dir, "events").select("event_id", digits.alias("offset"))
    return ops.normalise_offsets(events, "int")


_METADATA = """SELECT event_id,
       CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '{}' ELSE props END AS m FROM events"""


@query("prj4_normalise_metadata", f"""WITH given AS ({_METADATA})
SELECT event_id,
       coalesce(m, '{{}}') AS empty_object__empty_object,
       coalesce(m, '{{}}') AS empty_object__keep_null,
       coalesce(m, '{{}}') AS empty_as_null__empty_object,
       nullif(m, '{{}}') AS empty_as_null__keep_null,
       coalesce(m, '{{}}') AS null_only__empty_object,
       m AS null_only__keep_null,
       coalesce(m, '{{}}') AS json_null__empty_object,
       m AS json_null__keep_null
FROM given""")
def _(spark, sf_dir):
    given = F.when(F.col("event_id") % 4 == 1, "{}").when(F.col("event_id") % 4 > 1, F.col("props"))
    rows = supplied(spark, sf_dir, "events").select("event_id", given.alias("m"))
    for write in METADATA_WRITE_RULES:
        for read in METADATA_READ_RULES:
            name = f"{write}__{read}"
            rows = ops.normalise_metadata(rows.withColumn(name, F.col("m")), write, read, name)
    return rows.drop("m")


@query("prj5_normalise_times", """
SELECT event_id, ts AS iso, date_trunc('second', ts) AS iso_without_fraction, ts AS epoch_s,
       date_trunc('milliseconds', ts) AS epoch_ms, ts AS native FROM events""")
def _(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    rows = supplied(spark, sf_dir, "events").select(
        "event_id",
        format_time(ts, "iso").alias("iso"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("iso_without_fraction"),
        format_time(ts, "epoch_s").alias("epoch_s"),
        format_time(ts, "epoch_ms").alias("epoch_ms"),
        format_time(ts, "native").alias("native"),
    )
    for name, fmt in [
        ("iso", "iso"), ("iso_without_fraction", "iso"), ("epoch_s", "epoch_s"),
        ("epoch_ms", "epoch_ms"), ("native", "native"),
    ]:
        rows = ops.normalise_times(rows, name, fmt)
    return rows


@query("prj6_strip_system_fields", f"""WITH {EV_LOG}
SELECT pipeline_id, stream_id, offset_num, seq FROM ev_log""")
def _(spark, sf_dir):
    stored = event_log(spark, sf_dir).select(
        "pipeline_id", "stream_id", "offset_num", "seq",
        F.col("seq").cast("string").alias("_id"),
        F.lit("1-0").alias("_rev"),
        F.col("metadata").alias("payload"),
    )
    return ops.strip_system_fields(stored, also=["payload"])


@query("prj7_with_key", """
WITH k AS (SELECT event_id, event_type AS p, 'user ' || user_id || '/eu' AS s FROM events)
SELECT event_id,
       'cp:' || p || ':' || s AS colon,
       'cp:' || p || ':' || s AS colon_joined,
       p || ':' || s AS bare,
       p || '::' || s AS double_colon,
       'cp/' || p || '/' || s || '.json' AS path,
       'cp.' || p || '.' || s AS dot,
       'cp_' || p || '_' || s AS underscore,
       p || '__' || s AS double_underscore,
       'cp:' || replace(p || '__' || s, ' ', '_') AS record,
       replace(s, '/', '_') || '.json' AS file_name,
       replace(replace('cp:' || p || ':' || s, ':', '__'), '/', '_') AS document
FROM k""")
def _(spark, sf_dir):
    rows = supplied(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("pipeline_id"),
        F.concat(F.lit("user "), F.col("user_id"), F.lit("/eu")).alias("stream_id"),
    )
    rows = ops.with_key(rows, "colon", "cp", name="colon")
    rows = ops.with_key(rows, "colon_joined", "cp:", name="colon_joined")
    rows = ops.with_key(rows, "colon", name="bare")
    rows = ops.with_key(rows, "double_colon", name="double_colon")
    rows = ops.with_key(rows, "path", "cp/", suffix=".json", name="path")
    rows = ops.with_key(rows, "dot", "cp", name="dot")
    rows = ops.with_key(rows, "underscore", "cp", name="underscore")
    rows = ops.with_key(rows, "double_underscore", name="double_underscore")
    rows = ops.with_key(rows, "record", "cp", name="record")
    rows = ops.with_key(rows, "file_name", key_cols=["stream_id"], suffix=".json", name="file_name")
    rows = ops.with_key(rows, "document", "cp", name="document")
    return rows.drop("pipeline_id", "stream_id")


@query("prj8_split_key", """
SELECT event_id, event_type || '/user-' || user_id AS key_tail FROM events""")
def _(spark, sf_dir):
    keyed = ops.with_key(event_log(spark, sf_dir), "path", "ck", suffix=".json")
    return ops.split_key(keyed, "ck/", ".json").select(F.col("seq").alias("event_id"), "key_tail")


@query("prj9_rekey_report", """
WITH given AS (
    SELECT DISTINCT event_type AS p,
           'user' || CASE WHEN event_id % 2 = 0 THEN '/' ELSE '_' END || user_id AS s FROM events)
SELECT replace(p || '_' || s, '/', '_') AS key, count(*) AS n_sources FROM given
GROUP BY 1 HAVING count(*) > 1""")
def _(spark, sf_dir):
    mark = F.when(F.col("event_id") % 2 == 0, "/").otherwise("_")
    rows = supplied(spark, sf_dir, "events").select(
        F.col("event_type").alias("pipeline_id"),
        F.concat(F.lit("user"), mark, F.col("user_id")).alias("stream_id"),
    )
    return ops.rekey_report(rows, "file_name")


@query("prj9_rekey_report_urls", """
WITH urls AS (SELECT url FROM pages UNION ALL SELECT replace(url, '/en/', '_en/') FROM pages)
SELECT replace(replace(url, ':', '__'), '/', '_') AS key, count(DISTINCT url) AS n_sources
FROM urls GROUP BY 1 HAVING count(DISTINCT url) > 1""")
def _(spark, sf_dir):
    # English pages once more, by an address that differs in one separator.
    urls = supplied(spark, sf_dir, "pages").select("url")
    twin = urls.select(F.replace("url", F.lit("/en/"), F.lit("_en/")).alias("url"))
    return ops.rekey_report(urls.unionByName(twin), "document", key_cols=["url"])


@query("prj10_stable_id", """
SELECT event_id, md5('ckpt:' || event_type || ':user-' || user_id) AS stable_id FROM events""")
def _(spark, sf_dir):
    keyed = ops.with_key(event_log(spark, sf_dir), "colon", "ckpt")
    return ops.with_stable_id(keyed).select(F.col("seq").alias("event_id"), "stable_id")


@query("prj11_stamp_updated_at", """
SELECT event_id, TIMESTAMP '2024-02-01 12:00:00' AS always,
       CASE WHEN event_id % 2 = 0 THEN ts ELSE TIMESTAMP '2024-02-01 12:00:00' END AS if_null
FROM events""")
def _(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    rows = supplied(spark, sf_dir, "events").select(
        "event_id", ts.alias("always"), F.when(F.col("event_id") % 2 == 0, ts).alias("if_null")
    )
    rows = ops.stamp_updated_at(rows, "2024-02-01 12:00:00", "always", "always")
    return ops.stamp_updated_at(rows, "2024-02-01 12:00:00", "if_null", "if_null")


@query("prj12_with_payload_column", """
SELECT event_id, props AS payload, event_type AS id FROM events""")
def _(spark, sf_dir):
    log = ops.with_payload_column(event_log(spark, sf_dir))
    log = ops.with_copied_column(log, "id", "pipeline_id")
    return log.select(F.col("seq").alias("event_id"), "payload", "id")
