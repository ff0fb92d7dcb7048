"""The stages on a small corpus, each against a plain version."""

import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.brute import best_item
from tests.llm.brute import components as brute_components
from tests.llm.conftest import frame, odd_texts, prose
from tidelog.llm.tokens import default_tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of which some are junk, near copies, or hold an item of the benchmark."""
    path = tmp_path_factory.mktemp("tables")
    items = [(n, prose(700 + n, 30)) for n in range(3)]
    rows = [(n, prose(n, 80)) for n in range(60)]
    rows += [(100 + n, " ".join(w.upper() + "!!" for w in prose(200 + n, 60).split())) for n in range(30)]
    rows += [(200 + n, prose(n, 80) + " end") for n in range(10)]
    rows += [(300 + n, f"{prose(400 + n, 20)} {items[n % 3][1]} {prose(500 + n, 20)}") for n in range(6)]
    frame(spark, rows).select(*COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(n, 1, n % 7 == 0) for n in range(60)] + [(100 + n, 0, 0) for n in range(30)]
    labels = spark.createDataFrame([(n, q, int(t)) for n, q, t in labels], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    return str(path), rows, items


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages(spark, folder):
    path, rows, items = folder
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    good = stages["quality"](spark, docs, path)
    assert good.columns == COLUMNS
    assert ids(good) == [i for i, _ in rows if not 100 <= i < 200]

    texts = dict(rows)
    left = ids(good)
    one = stages["near_copies"](spark, good, path)
    groups, _ = brute_components([texts[i] for i in left])
    assert one.columns == COLUMNS and ids(one) == sorted({min(left[n] for n in g) for g in groups})
    assert len(ids(one)) == len(left) - 10

    clean = stages["benchmark"](spark, one, path)
    assert clean.columns == COLUMNS and ids(clean) == [i for i in ids(one) if not best_item(texts[i], items)]
    assert max(ids(clean)) < 100

    mixture = stages["mixture"](spark, clean, path)
    assert mixture.columns == COLUMNS
    assert {i for i in ids(clean) if i % 7} <= set(ids(mixture)) <= set(ids(clean))

    got = stages["token_ids"](spark, mixture, path).orderBy("start").collect()
    tokenizer, at = Tokenizer.from_file(default_tokenizer()), 0
    assert [r["doc_id"] for r in got] == ids(mixture)
    for r in got:
        found = [*tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 0]
        crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in found))
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(found), crc)
        at += len(found)


def test_odd_texts_go_through(spark, odd, folder):
    path, _, _ = folder
    docs = odd.select(*COLUMNS)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, path)
        assert docs.columns == COLUMNS, name
        assert 0 < docs.count() <= len(odd_texts()) * 2
    whole = docs.agg(F.count("*")).first()[0]
    assert corpus_pipeline.token_ids(spark, docs, path).count() == whole


CLASHING = ["_number", "_mark", "_often", "_score", "_d", "_h", "places", "posterior", "n_tokens", "rate"]


@pytest.mark.parametrize("files", [1, 7])
def test_any_file_layout_and_any_columns(spark, folder, files, tmp_path):
    """The same documents stay however they lie in files, and columns with names used inside come out as they were."""
    path, rows, _ = folder
    docs = frame(spark, [*rows, *rows[:5], (None, None), (None, "")]).select(*COLUMNS)
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in CLASHING})
    docs.repartition(files, "doc_id").sortWithinPartitions("doc_id" if files > 1 else F.desc("text")).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == COLUMNS + CLASHING
        stored = docs.collect()
        for row in stored:
            if row["doc_id"] is not None:
                assert [row[c] for c in CLASHING] == [f"{c} of {row['doc_id']}" for c in CLASHING]
        kept[name] = sorted(repr(tuple(r)) for r in stored)
    known = _LAYOUTS.setdefault("kept", kept)
    assert known == kept


_LAYOUTS: dict = {}
