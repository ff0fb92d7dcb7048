import json

import pandas as pd
import pytest
from conftest import HARBOURS, rows
from pyspark.sql import functions as F

from tidelog.functions import udfs
from tidelog.functions.scalars import json_value, with_json_field
from tidelog.operators import changelog as ch
from tidelog.operators import columns as c
from tidelog.operators import ordered
from tidelog.operators import relational as r
from tidelog.plans.user_functions import COUNT_SUM as VALUES
from tidelog.plans.user_functions import MEAN, SPREAD


SCHEMA = "name string, berths int, place struct<land: string, coast: string>"


@pytest.fixture
def parsed(harbours):
    fields = {
        "name": json_value("data", "$.name"),
        "berths": json_value("data", "$.berths"),
        "land": json_value("data", "$.place.land"),
    }
    return c.drop_columns(c.add_columns(harbours, fields), "data")


def test_add_columns_and_errors(parsed):
    assert rows(parsed) == [(n, name, b if b is None else str(b), land) for n, name, b, land, _ in HARBOURS]
    with pytest.raises(ValueError, match="already present: NAME"):
        c.add_columns(parsed, {"NAME": F.lit(1)})
    with pytest.raises(ValueError, match="no such columns: depth"):
        c.drop_columns(parsed, "depth")


def test_replace_rename_filter_limit(parsed):
    replaced = c.add_or_replace_columns(parsed, {"id": F.concat(F.lit("h"), F.col("id").cast("string"))})
    assert [x[0] for x in rows(replaced)] == [f"h{h[0]}" for h in HARBOURS]
    assert c.rename_columns(parsed, {"id": "r_id"}).columns == ["r_id", "name", "berths", "land"]
    assert [x[0] for x in rows(parsed.filter(F.col("id") != 14))] == [11, 12, 13, 15, 16]
    assert r.limit(parsed, 4).count() == 4
    assert [x[0] for x in r.limit(parsed, 2, ["name"]).collect()] == [13, 15]


def test_group_distinct(parsed):
    grouped = r.group(parsed, ["land"], {"n": F.count("id"), "top": F.max(F.col("berths").cast("bigint"))})
    assert rows(grouped) == [("DK", 2, 410), ("NO", 3, 240), ("UK", 1, None)]
    assert rows(r.distinct(parsed, "land")) == [("DK",), ("NO",), ("UK",)]


def test_changelog_of_group(parsed):
    numbers = parsed.withColumn("berths", F.col("berths").cast("bigint"))
    aggregates = {"n": ("count", "id"), "top": ("max", "berths")}
    for most in (1, 1_000):
        changes = ch.aggregate_changelog(numbers, ["land"], ["id"], aggregates, most)
        norway = changes.filter("land = 'NO'").select("id", "op", "n", "top")
        new = [(12, "+I", 1, 95), (14, "+U", 2, 240), (16, "+U", 3, 240)]
        old = [(14, "-U", 1, 95), (16, "-U", 2, 240)]
        assert rows(norway) == sorted([*new, *old], key=repr)
        assert rows(ch.keep_upserts(norway)) == new
    # the third harbour does not change the maximum
    top = ch.aggregate_changelog(numbers, ["land"], ["id"], {"top": ("max", "berths")})
    assert rows(top.filter("land = 'NO'").select("op", "top")) == [("+I", 95), ("+U", 240), ("-U", 95)]


def test_a_changelog_leads_to_its_aggregate(parsed):
    """An old and a new value share a place in the sequence: the new one counts."""
    numbers = parsed.withColumn("berths", F.col("berths").cast("bigint"))
    aggregates = {"n": ("count", "id"), "total": ("sum", "berths")}
    changes = ch.aggregate_changelog(numbers, ["land"], ["id"], aggregates)
    table = ch.apply_changes(changes, ["land"], ["id"]).select("land", "n", "total")
    grouped = r.group(numbers, ["land"], {"n": F.count("id"), "total": F.sum("berths")})
    assert rows(table) == rows(grouped)


def test_join(spark, parsed):
    depths = spark.createDataFrame([(11, 9.5), (13, 7.0), (16, 4.0), (99, 1.0)], "id bigint, depth double")
    with pytest.raises(ValueError, match="rename"):
        r.join(parsed, depths, F.lit(True))
    joined = r.join(parsed, c.rename_columns(depths, {"id": "r_id"}), F.col("id") == F.col("r_id"))
    assert rows(joined.select("id", "name", "depth")) == [(11, "Skagen", 9.5), (13, "Grimsby", 7.0), (16, "Mandal", 4.0)]


def test_lateral(spark, parsed, harbours):
    want = sorted((n, piece) for n, name, *_ in HARBOURS for piece in name.split("s"))
    assert rows(r.lateral_split(parsed, "name", "s", "a").select("id", "a")) == want
    udfs.register(spark)
    sql = spark.sql("SELECT id, t.part FROM {rows}, LATERAL split_on(name, 's') t", rows=parsed)
    assert rows(sql) == want
    native = r.lateral_json(harbours, "data", SCHEMA)
    assert rows(native.select("id", "berths", "place.coast")) == [(n, b, coast) for n, _, b, _, coast in HARBOURS]


def test_lateral_split_keeps_empty_pieces_and_quotes_the_separator(spark):
    df = spark.createDataFrame([(1, "i"), (2, ""), (3, None), (4, "a.b")], "id int, t string")
    assert rows(r.lateral_split(df, "t", "i", "p").select("id", "p")) == [
        (1, ""),
        (1, ""),
        (2, ""),
        (4, "a.b"),
    ]
    assert rows(r.lateral_split(df, "t", ".", "p").filter("id = 4").select("p")) == [("a",), ("b",)]


def test_change_json_field(harbours):
    changed = harbours.select("id", with_json_field("data", SCHEMA, "berths", lambda n: n - 5).alias("data"))
    got = changed.select("id", F.get_json_object("data", "$.berths"), F.get_json_object("data", "$.place.coast"))
    assert rows(got) == [(n, b if b is None else str(b - 5), coast) for n, _, b, _, coast in HARBOURS]


def test_running_sum_golden(parsed):
    numbers = parsed.withColumn("berths", F.col("berths").cast("bigint"))
    out = ordered.running(numbers, ["land"], ["id"], {"total": ("sum", "berths")})
    assert rows(out.select("id", "total")) == [(11, 410), (12, 95), (13, None), (14, 335), (15, 470), (16, 575)]


COUNT_SUM = r.UserAggregate(
    create=lambda: (0, 0),
    accumulate=lambda s, g: (s[0] + len(g), s[1] + int(g["number"].sum())),
    merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
    finish=lambda s: [s],
    state="cnt bigint, total bigint",
    output="cnt bigint, total bigint",
)


def test_user_aggregates(spark, parsed):
    numbers = parsed.filter("berths IS NOT NULL").withColumn("number", F.col("berths").cast("int"))
    out = r.user_aggregate(numbers.repartition(3), ["land"], ["number"], COUNT_SUM)
    assert rows(out) == [("DK", 2, 470), ("NO", 3, 575)]

    top2 = r.UserAggregate(
        create=lambda: ([],),
        accumulate=lambda s, g: (sorted([*s[0], *g["number"].tolist()], reverse=True)[:2],),
        merge=lambda a, b: (sorted([*a[0], *b[0]], reverse=True)[:2],),
        finish=lambda s: [(v,) for v in s[0]],
        state="best array<bigint>",
        output="number bigint",
    )
    out = r.user_aggregate(numbers.repartition(3), ["land"], ["number"], top2)
    assert rows(out) == [("DK", 410), ("DK", 60), ("NO", 240), ("NO", 240)]
    native = r.top_n(numbers, ["land"], [F.col("number").desc()], 2)
    assert rows(native.select("land", "number")) == rows(out)


def test_user_aggregate_null_keys(spark):
    df = spark.createDataFrame([(1, 2), (None, 3), (None, 4), (7, 5)], "k bigint, number int")
    out = r.user_aggregate(df.repartition(2), ["k"], ["number"], COUNT_SUM)
    assert rows(out) == [(1, 1, 2), (7, 1, 5), (None, 2, 7)]


def test_user_aggregate_keeps_all_digits(spark):
    """Whole numbers beyond 2^53 beside NULL, as keys and as values."""
    big = 2**60
    data = [(big + 1, big + 1), (big + 2, 1), (big + 2, big), (None, None), (None, 5), (3, None)]
    df = spark.createDataFrame(data, "k bigint, number bigint").coalesce(1)
    exact = r.UserAggregate(
        create=lambda: (0, 0),
        accumulate=lambda s, g: (s[0] + int(g["number"].count()), s[1] + int(g["number"].sum())),
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        finish=lambda s: [s],
        state="cnt bigint, total bigint",
        output="cnt bigint, total bigint",
    )
    want = [(big + 1, 1, big + 1), (big + 2, 2, big + 1), (3, 0, 0), (None, 1, 5)]
    assert rows(r.user_aggregate(df, ["k"], ["number"], exact)) == sorted(want, key=repr)


def test_user_aggregates_skip_missing_numbers(spark):
    data = [("a", 1.0), ("a", None), ("b", None), ("c", 2.0), ("c", float("nan")), ("c", 4.0)]
    df = spark.createDataFrame(data, "k string, value double").repartition(2)
    plain = df.filter("k <> 'c'")
    assert rows(r.user_aggregate(plain, ["k"], ["value"], MEAN)) == [("a", 1.0), ("b", None)]
    assert rows(r.user_aggregate(plain, ["k"], ["value"], VALUES)) == [("a", 1, 1.0), ("b", 0, None)]
    assert rows(r.user_aggregate(plain, ["k"], ["value"], SPREAD)) == [("a", 2, 0.0), ("b", 1, None)]


def test_word_count(spark):
    df = spark.createDataFrame([(" a b\ta ",), ("b c\n",), (None,), ("",)], "line string")
    assert rows(r.word_count(df, "line")) == [("a", 2), ("b", 2), ("c", 1)]


def test_latest_per_key_and_apply_changes(spark):
    df = spark.createDataFrame(
        [(1, "x", 1, "I"), (1, "y", 3, "U"), (1, "z", 2, "U"), (2, "q", 1, "I"), (2, "q", 5, "D")],
        "k int, v string, seq int, op string",
    )
    assert rows(r.latest_per_key(df, ["k"], ["seq"])) == [(1, "y", 3, "U"), (2, "q", 5, "D")]
    assert rows(ch.apply_changes(df, ["k"], ["seq"])) == [(1, "y", 3)]


def test_views_and_plans(spark, parsed):
    assert c.select_all_sql(parsed).count() == len(HARBOURS)
    assert c.temporary_view(parsed, "some_rows").count() == len(HARBOURS)
    assert c.drop_view(spark, "some_rows") and not c.drop_view(spark, "some_rows")
    assert "Exchange" in c.plan_text(r.count_rows(parsed, ["land"]))
    assert c.rename_all(parsed, "a", "b", "c", "d").columns == ["a", "b", "c", "d"]


def test_map_rows(harbours):
    def coast(batch):
        return pd.DataFrame({"id": batch["id"], "coast": [json.loads(d)["place"]["coast"] for d in batch["data"]]})

    got = udfs.map_rows(harbours, coast, "id bigint, coast string")
    assert rows(got) == [(n, coast_name) for n, _, _, _, coast_name in HARBOURS]


def test_user_code_is_called_once_for_the_rows_of_a_key_that_a_task_has(spark):
    """Keys whose rows are spread over many record batches; states meet without a call into pandas for each key."""
    calls = r.UserAggregate(
        create=lambda: (0, 0),
        accumulate=lambda state, rows: (state[0] + 1, state[1] + len(rows)),
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        finish=lambda state: [state],
        state="calls bigint, n bigint",
        output="calls bigint, n bigint",
    )
    df = spark.range(0, 60_000, 1, 1).select((F.col("id") % 700).alias("k"), F.col("id").alias("value"))
    out = r.user_aggregate(df, ["k"], ["value"], calls)
    assert out.agg(F.count("*"), F.sum("calls"), F.sum("n")).collect() == [(700, 700, 60_000)]
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().optimizedPlan().toString()
