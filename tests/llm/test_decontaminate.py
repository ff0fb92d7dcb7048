from pyspark.sql import functions as F

from tests.llm.brute import best_item
from tests.llm.conftest import frame, odd_texts, prose
from tidelog.llm import decontaminate


def test_simhash_and_blocks(spark):
    rows = spark.createDataFrame([([1, 3, 3],), ([-1, 0, -1],), ([],)], "marks array<bigint>")
    got = [r[0] for r in rows.select(decontaminate.simhash(F.col("marks"))).collect()]
    assert got == [3, -1, 0]
    bits = spark.createDataFrame([(-1,)], "bits bigint")
    blocks = bits.select(F.inline(decontaminate.window_blocks("bits"))).collect()
    assert sum((r["value"] + 1).bit_length() - 1 for r in blocks) == 64


def test_documents_with_items(spark):
    items = [(n, prose(500 + n, 14 + 5 * n)) for n in range(8)] + [(20, None), (21, ""), (22, "one"), (23, prose(500, 14))]
    words = items[6][1].split()
    rows = odd_texts()
    rows += [
        (100, f"{prose(1, 30)} {items[3][1].upper()} {prose(2, 30)}"),
        (101, items[0][1]),
        (102, f"{prose(3, 9)}\n{items[6][1].replace(' ', chr(10))}"),
        (103, " ".join([*words[:43], "changed"])),  # the last word of 44
        (104, " ".join([*prose(4, 12).split(), *words[:20], "inserted", *words[20:]])),
        (105, " ".join(words[3:])),
        (106, f"{items[2][1]} {items[5][1]}"),
        (None, items[4][1]),
        (None, items[4][1]),
    ]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, marks string")
    docs = frame(spark, rows)
    got = decontaminate.contamination(docs, benchmark).collect()
    want = [(i, best_item(t, items)) for i, t in rows]
    found = [(r["doc_id"], (r["item_id"], r["similarity"], r["at"]) if r["contaminated"] else None) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert {i for i, b in want if b} >= {12, 100, 101, 102, 103, 106, None}
    clean = decontaminate.without_benchmark(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted((r["doc_id"] for r in clean.collect()), key=repr) == sorted((i for i, b in want if not b), key=repr)


def test_items_with_their_parts_in_another_order(spark):
    items = [(1, prose(600, 59)), (2, prose(601, 40)), (3, "x y z u v w " * 9)]
    one, two = items[0][1].split(), items[1][1].split()
    docs = [
        (1, " ".join([prose(602, 30), *one[29:], *one[:29], prose(603, 30)])),
        (2, " ".join([prose(604, 30), *two[-8:], *two[:-8], prose(605, 30)])),
        (3, " ".join([*one[29:], *one[:29]])),
        (4, " ".join([*two[20:], prose(606, 15), *two[:20]])),
        (5, "z u v w x y " * 40),
        (None, " ".join([*two[-8:], *two[:-8], prose(607, 300), *one[29:], *one[:29]])),
    ]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contamination(frame(spark, docs), benchmark).collect()
    found = {r["doc_id"]: (r["item_id"], r["similarity"], r["at"]) if r["contaminated"] else None for r in got}
    want = {i: best_item(t, items) for i, t in docs}
    assert found == want
    assert [i for i, b in want.items() if not b] == [4]


def test_no_rows(spark, nothing, odd):
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contamination(nothing, benchmark).collect() == []
    assert not any(r["contaminated"] for r in decontaminate.contamination(odd, benchmark).collect())


def test_runs_no_python(spark, odd):
    benchmark = spark.createDataFrame([(1, prose(1, 40))], "item_id bigint, text string")
    plan = decontaminate.contamination(odd, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
