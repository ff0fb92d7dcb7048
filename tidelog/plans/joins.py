"""Joins and lateral expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions import udfs
from tidelog.operators import relational as r
from tidelog.operators.columns import rename_columns
from tidelog.plans.registry import EDGE_SQL, edge_message, query, table


@query(
    "j1_inner_join",
    "SELECT o_orderkey, o_totalprice, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def inner_join(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return r.join(orders, customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey")


@query(
    "j1_join_chain",
    "SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders "
    "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
)
def join_chain(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    # orders are summed per customer first: a customer with very many orders joins as one row
    per_customer = r.group(
        orders, ["o_custkey"], {"n": F.count("*"), "spent": F.sum("o_totalprice")}
    )
    joined = r.join(per_customer, customers, F.col("o_custkey") == F.col("c_custkey"))
    joined = r.join(joined, nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return r.group(
        joined, ["n_name"], {"orders": F.sum("n"), "total": F.round(F.sum("spent"), 2)}
    )


@query(
    "j1_join_same_key_names",
    "SELECT d.doc_id, d.lang, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def join_renamed(spark, sf):
    labels = rename_columns(table(spark, sf, "labels"), {"doc_id": "label_doc"})
    joined = r.join(
        table(spark, sf, "documents").select("doc_id", "lang"), labels, F.col("doc_id") == F.col("label_doc")
    )
    return joined.select("doc_id", "lang", "quality")


_SPLIT_SQL = "SELECT p_partkey, unnest(string_split(p_name, 'e')) AS part FROM part"


@query("j2_lateral_split", _SPLIT_SQL)
def lateral_split(spark, sf):
    return r.lateral_split(table(spark, sf, "part"), "p_name", "e", "part").select("p_partkey", "part")


@query("j2_lateral_udtf", _SPLIT_SQL)
def lateral_udtf(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    pieces = udfs.SplitOn(F.col("p_name").outer(), F.lit("e"))
    return parts.lateralJoin(pieces).select("p_partkey", "part")


_FIELDS_SQL = f"WITH {EDGE_SQL} SELECT event_id, org, url, status FROM edge"


@query("j3_lateral_json", _FIELDS_SQL)
def lateral_json(spark, sf):
    lines = edge_message(table(spark, sf, "events"))
    schema = "ClientRequestURI string, EdgeResponseStatus int, ResponseHeaders struct<`x-org-uid`: string>"
    return r.lateral_json(lines, "value", schema).select(
        "event_id",
        F.col("ResponseHeaders")["x-org-uid"].alias("org"),
        F.col("ClientRequestURI").alias("url"),
        F.col("EdgeResponseStatus").alias("status"),
    )


@query("j3_lateral_sql_function", _FIELDS_SQL)
def lateral_sql(spark, sf):
    udfs.register(spark)
    lines = edge_message(table(spark, sf, "events"))
    return spark.sql(
        "SELECT event_id, t.org, t.url, t.status FROM {lines}, LATERAL edge_fields(value) t", lines=lines
    )


@query(
    "j4_unnest",
    "SELECT vec_id, label, unnest(embedding) AS component FROM embeddings",
)
def unnest(spark, sf):
    return r.unnest(table(spark, sf, "embeddings"), "embedding", "component")


@query(
    "j4_unnest_position",
    "SELECT doc_id, CAST(i AS INTEGER) AS line_no, lines[i + 1] AS line FROM "
    "(SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents) d, range(0, len(lines)) r(i)",
)
def unnest_position(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.split("text", "\n", -1).alias("lines"))
    return r.unnest(lines, "lines", "line", position="line_no")
