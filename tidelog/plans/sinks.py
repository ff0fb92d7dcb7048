"""Writers and keyed upserts: each query writes, and returns what a reader then sees."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions.scalars import document_id
from tidelog.operators import changelog as c
from tidelog.operators import relational as r
from tidelog.operators import windows as w
from tidelog.operators.columns import parse_json
from tidelog.plans.registry import EDGE_SQL, EPOCH, edge_logs, edge_message, query, table
from tidelog.session import work_dir
from tidelog.sinks import files as sink
from tidelog.sinks.keyed import KeyedTable
from tidelog.sources import files
from tidelog.sources.messages import EDGE_LOG, with_edge_columns
from tidelog.streaming import jobs

# micro-batches of the staged event streams
BATCHES = 4


def staged(spark, rows):
    """Rows with an `event_id` as a stream of several micro-batches; as many files as the input has parts, or more."""
    path = work_dir(spark, "staged")
    per_batch = -(-max(BATCHES, rows.rdd.getNumPartitions()) // BATCHES)
    rows.repartitionByRange(per_batch * BATCHES, "event_id").write.parquet(path)
    return files.parquet_rows(spark, path, stream=True, files_per_batch=per_batch)


def staged_events(spark, sf, *columns):
    return staged(spark, table(spark, sf, "events").select("event_id", *columns))


@query("k2_upsert_stream", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def upsert_stream(spark, sf):
    """Running counts, each new value replacing the one stored."""
    keys = ["user_id", "event_type"]
    counts = staged_events(spark, sf, *keys).groupBy(*keys).agg(F.count("*").alias("n"))
    path = work_dir(spark, "counts")
    jobs.upsert(counts, path, keys, f"{path}-checkpoint").awaitTermination()
    return KeyedTable(spark, path, keys).read()


@query(
    "k3_additive_upsert_stream",
    "SELECT user_id, count(*) AS n, round(sum(value), 4) AS total, max(value) AS top FROM events GROUP BY 1",
)
def additive_upsert_stream(spark, sf):
    """Each micro-batch adds its own counts and sums to what is stored."""
    rows = staged_events(spark, sf, "user_id", "value").select(
        "user_id", F.lit(1).cast("bigint").alias("n"), F.col("value").alias("total"), F.col("value").alias("top")
    )
    merges = {"n": "sum", "total": "sum", "top": "max"}
    path = work_dir(spark, "totals")
    jobs.upsert(rows, path, ["user_id"], f"{path}-checkpoint", merges, mode="append").awaitTermination()
    stored = KeyedTable(spark, path, ["user_id"], merges)
    stored.compact()
    return stored.read().withColumn("total", F.round("total", 4))


@query(
    "k4_latest_stream",
    "SELECT user_id, arg_max(event_type, event_id) AS last_type, max(event_id) AS event_id FROM events GROUP BY 1",
)
def latest_stream(spark, sf):
    rows = staged_events(spark, sf, "user_id", "event_type").withColumnRenamed("event_type", "last_type")
    path = work_dir(spark, "latest")
    jobs.upsert(
        rows, path, ["user_id"], f"{path}-checkpoint", sequence=["event_id"], mode="append"
    ).awaitTermination()
    return KeyedTable(spark, path, ["user_id"], sequence=["event_id"]).read()


@query(
    "k5_newest_per_document",
    "SELECT CAST(user_id AS VARCHAR) || '_' || event_type AS doc_id, max(event_id) AS event_id, "
    "arg_max(value, event_id) AS value FROM events GROUP BY 1",
)
def newest_per_document(spark, sf):
    rows = table(spark, sf, "events").select(
        F.concat_ws("_", F.col("user_id").cast("string"), "event_type").alias("doc_id"), "event_id", "value"
    )
    return sink.newest_documents(rows, "doc_id", ["event_id"])


@query(
    "k6_bulk_actions",
    f"""
    WITH {EDGE_SQL}, docs AS (
      SELECT org || '_' || day || '_' || translate(url, '/?&', '___') AS id, org, day, url, count(*) AS n
      FROM edge GROUP BY org, day, url)
    SELECT '{{"update":{{"_index":"url_counts","_id":"' || id || '"}}}}' AS value FROM docs
    UNION ALL
    SELECT '{{"doc":{{"org_id":"' || org || '","date":"' || day || '","url":"' || url || '","url_count":' || n
      || '}},"doc_as_upsert":true}}' FROM docs
    """,
)
def bulk_actions(spark, sf):
    logs = edge_logs(spark, sf).select(
        F.col("OrgUID").alias("org_id"), F.col("DateStr").alias("date"), F.col("ClientRequestURI").alias("url")
    )
    counted = r.count_rows(logs, ["org_id", "date", "url"], "url_count")
    named = counted.withColumn("doc_id", document_id("org_id", "date", "url"))
    path = work_dir(spark, "bulk")
    sink.write_text(
        sink.upsert_actions(named, "url_counts", "doc_id", ["org_id", "date", "url", "url_count"]), path
    )
    return files.text_lines(spark, path)


@query("k7_static_index", "SELECT 'customers' AS _index, c_custkey AS _id, c_name FROM customer")
def static_index(spark, sf):
    named = table(spark, sf, "customer").select(F.col("c_custkey").alias("_id"), "c_name")
    path = work_dir(spark, "index")
    sink.write_by_index(sink.static_index(named, "customers"), path, "_index")
    return spark.read.parquet(path).select("_index", "_id", "c_name")


@query("k7_dynamic_index", "SELECT event_type AS _index, event_id AS _id, value FROM events")
def dynamic_index(spark, sf):
    rows = sink.dynamic_index(table(spark, sf, "events"), "event_type")
    path = work_dir(spark, "index")
    sink.write_by_index(rows.select("_index", F.col("event_id").alias("_id"), "value"), path, "_index")
    return spark.read.parquet(path).select("_index", "_id", "value")


@query(
    "k8_documents",
    f"""
    SELECT '{{"event_type":"' || event_type || '","n":' || count(*) || ',"window_start":"'
      || strftime(time_bucket(INTERVAL 1 DAY, ts, {EPOCH}), '%Y-%m-%dT%H:%M:%S') || '"}}' AS value
    FROM events GROUP BY event_type, time_bucket(INTERVAL 1 DAY, ts, {EPOCH})
    """,
)
def documents(spark, sf):
    counted = w.time_windows(
        table(spark, sf, "events"), ["event_type"], "ts", "1 day", {"n": F.count("*")}
    ).withColumn("window_start", sink.iso_text("window_start"))
    path = work_dir(spark, "documents")
    sink.write_text(sink.documents(counted, "event_type", "n", "window_start"), path)
    return files.text_lines(spark, path)


@query("k9_text_files", "SELECT c_name AS value FROM customer")
def text_files(spark, sf):
    path = work_dir(spark, "rows")
    sink.write_text(table(spark, sf, "customer").select("c_name"), path, rows_per_file=100_000)
    return files.text_lines(spark, path)


@query("k10_csv_stream", "SELECT event_id, user_id, value FROM events")
def csv_stream(spark, sf):
    rows = files.parquet_rows(spark, f"{sf}/events.parquet", stream=True).select("event_id", "user_id", "value")
    path = work_dir(spark, "csv")
    jobs.to_files(rows, path, f"{path}-checkpoint", format="csv").awaitTermination()
    return files.csv_rows(spark, path, "event_id bigint, user_id bigint, value double")


@query(
    "k11_change_documents",
    """
    WITH seen AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
    SELECT '{"data":[{"user_id":' || user_id || ',"n":' || n || '}],"type":"INSERT"}' AS value FROM seen
    UNION ALL
    SELECT '{"data":[{"user_id":' || user_id || ',"n":' || (n - 1) || '}],"type":"DELETE"}' FROM seen WHERE n > 1
    """,
)
def change_documents(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id")
    changes = c.aggregate_changelog(events, ["user_id"], ["ts", "event_id"], {"n": ("count", F.lit(1))})
    path = work_dir(spark, "changes")
    sink.write_text(c.change_documents(changes, ["user_id", "n"]), path)
    return files.text_lines(spark, path)


@query("k11_insert_documents", "SELECT '{\"data\":[{\"word_id\":' || user_id || '}],\"type\":\"INSERT\"}' AS value FROM events")
def insert_documents(spark, sf):
    rows = c.insert_changes(table(spark, sf, "events").select(F.col("user_id").alias("word_id")))
    return c.change_documents(rows, ["word_id"])


@query("k12_string_payloads", "SELECT CAST(user_id AS VARCHAR) AS value FROM events")
def string_payloads(spark, sf):
    return sink.encode_string(table(spark, sf, "events"), "user_id")


@query(
    "k12_json_payloads",
    "SELECT '{\"r_regionkey\":' || r_regionkey || ',\"r_name\":\"' || r_name || '\"}' AS value FROM region",
)
def json_payloads(spark, sf):
    return sink.encode_json(table(spark, sf, "region"))


@query("k13_last_snapshot", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def last_snapshot(spark, sf):
    """The whole aggregate is appended after every micro-batch; the last one is complete."""
    counts = staged_events(spark, sf, "event_type").groupBy("event_type").agg(F.count("*").alias("n"))
    path = work_dir(spark, "snapshots")
    jobs.snapshots(counts, path, f"{path}-checkpoint").awaitTermination()
    stored = spark.read.parquet(path)
    last = stored.agg(F.max("snapshot_id").alias("snapshot_id"))
    return stored.join(F.broadcast(last), "snapshot_id").select("event_type", "n")


@query(
    "k14_several_sinks",
    "SELECT 'low' AS sink, event_id, event_type FROM events WHERE user_id <= 30 "
    "UNION ALL SELECT 'view', event_id, event_type FROM events WHERE contains(event_type, 'view')",
)
def several_sinks(spark, sf):
    root = work_dir(spark, "branches")
    rows = staged_events(spark, sf, "user_id", "event_type")
    branches = {
        f"{root}/sink=low": lambda batch: batch.filter("user_id <= 30").drop("user_id"),
        f"{root}/sink=view": lambda batch: batch.filter(F.col("event_type").contains("view")).drop("user_id"),
    }
    jobs.fan_out(rows, branches, f"{root}-checkpoint").awaitTermination()
    return spark.read.schema("event_id bigint, event_type string, sink string").parquet(root).select(
        "sink", "event_id", "event_type"
    )


@query("k14_several_sinks_batch", "SELECT r_name, 'r' AS sink FROM region UNION ALL SELECT n_name, 'n' FROM nation")
def several_sinks_batch(spark, sf):
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    root = work_dir(spark, "branches")
    sink.write_branches(
        {
            f"{root}/sink=r": nations.select("r_name").distinct(),
            f"{root}/sink=n": nations.select(F.col("n_name").alias("r_name")),
        },
    )
    return spark.read.schema("r_name string, sink string").parquet(root)


@query("k15_insert_into", "SELECT event_id, abs(user_id) % 10 AS num FROM events")
def insert_into(spark, sf):
    path = work_dir(spark, "declared")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE TABLE {name} (num BIGINT, event_id BIGINT) USING parquet LOCATION '{path}'")
    try:
        rows = table(spark, sf, "events").select("event_id", (F.abs("user_id") % 10).alias("num"))
        sink.insert_into(rows, name)
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.read.schema("num bigint, event_id bigint").parquet(path).select("event_id", "num")


@query(
    "k16_report",
    f"WITH {EDGE_SQL} SELECT org AS \"OrgUID\", status AS \"EdgeResponseStatus\", count(status) AS status_count "
    "FROM edge GROUP BY 1, 2",
)
def report(spark, sf):
    counted = r.count_values(
        edge_logs(spark, sf), ["OrgUID", "EdgeResponseStatus"], "EdgeResponseStatus", "status_count"
    )
    path = work_dir(spark, "report")
    sink.write_report(counted, path)
    return files.csv_rows(spark, path, "OrgUID string, EdgeResponseStatus int, status_count bigint", header=True)


_MAIN_SQL = f"""
{EDGE_SQL}, urls AS (
  SELECT org, day, url, count(url) AS n, org || '_' || day || '_' || translate(url, '/?&', '___') AS id
  FROM edge GROUP BY org, day, url),
statuses AS (
  SELECT org, day, status, count(status) AS n, org || '_' || day || '_' || status AS id FROM edge GROUP BY org, day, status),
latest AS (SELECT org, max(event_id) AS event_id, arg_max(url, event_id) AS url FROM edge GROUP BY org)
"""


def _main_job(spark, sf):
    """One stream of JSON messages keeps three tables: counts by URL and by status, the latest log of each organisation."""
    messages = staged(spark, edge_message(table(spark, sf, "events")))
    logs = with_edge_columns(parse_json(messages, "value", EDGE_LOG)).select(
        "event_id",
        F.col("OrgUID").alias("org"),
        F.col("DateStr").alias("day"),
        F.col("ClientRequestURI").alias("url"),
        F.col("EdgeResponseStatus").alias("status"),
        "EventTime",
    )
    root = work_dir(spark, "main")
    one = F.lit(1).cast("bigint").alias("n")
    options = {
        "urls": {"keys": ["org", "day", "url"], "merges": {"n": "sum"}},
        "statuses": {"keys": ["org", "day", "status"], "merges": {"n": "sum"}},
        "latest": {"keys": ["org"], "sequence": ["event_id"]},
    }
    branches = {
        "urls": lambda b: b.select("org", "day", "url", one),
        "statuses": lambda b: b.filter("status IS NOT NULL").select("org", "day", "status", one),
        "latest": lambda b: b.select("org", "url", "event_id"),
    }
    tables = {f"{root}/{name}": (branches[name], options[name]) for name in options}
    jobs.upsert_several(logs, tables, f"{root}/checkpoint").awaitTermination()
    return {name: KeyedTable(spark, f"{root}/{name}", **options[name]).rows() for name in options}


@query(
    "k14_main_job",
    f"WITH {_MAIN_SQL} SELECT 'urls' AS kind, id, n FROM urls UNION ALL SELECT 'statuses', id, n FROM statuses "
    "UNION ALL SELECT 'latest', org || '_' || url, event_id FROM latest",
)
def main_job(spark, sf):
    tables = _main_job(spark, sf)
    urls = tables["urls"].select(F.lit("urls").alias("kind"), document_id("org", "day", "url").alias("id"), "n")
    statuses = tables["statuses"].select(
        F.lit("statuses"), document_id("org", "day", F.col("status").cast("string")), "n"
    )
    latest = tables["latest"].select(F.lit("latest"), F.concat_ws("_", "org", "url"), "event_id")
    return urls.union(statuses).union(latest)


@query(
    "k6_main_job_bulk",
    f"""
    WITH {_MAIN_SQL}
    SELECT '{{"update":{{"_index":"status_counts","_id":"' || id || '"}}}}' AS value FROM statuses
    UNION ALL
    SELECT '{{"doc":{{"org":"' || org || '","day":"' || day || '","status":' || status || ',"n":' || n
      || '}},"doc_as_upsert":true}}' FROM statuses
    """,
)
def main_job_bulk(spark, sf):
    """The bulk lines that the status table of the main job leads to."""
    statuses = _main_job(spark, sf)["statuses"]
    named = statuses.withColumn("doc_id", document_id("org", "day", F.col("status").cast("string")))
    path = work_dir(spark, "bulk")
    sink.write_text(sink.upsert_actions(named, "status_counts", "doc_id", ["org", "day", "status", "n"]), path)
    return files.text_lines(spark, path)
