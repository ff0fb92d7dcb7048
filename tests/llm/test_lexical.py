import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import frame, odd_texts, prose
from tidelog.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, best=20):
    """Every document scored for every item."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    out = []
    for item, text in items:
        found = []
        for (i, c), n in zip(counted, sizes, strict=True):
            score = 0
            for t in terms(text):
                if not c[t]:
                    continue
                df = sum(t in other for _, other in counted)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                m = 100 - 25 + (25 * n * n_docs) // total
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, i is None, i or 0))
        found.sort()
        out += [(item, r, None if no_id else i, -s) for r, (s, no_id, i) in enumerate(found[:best], 1)]
    return sorted(out, key=repr)


def benchmark(spark, rows):
    full = [(i, t, 1, 2, 0.5, "x") for i, t in rows]
    return spark.createDataFrame(full, "item_id bigint, text string, item int, rank int, score double, terms string")


def check(spark, docs, items, **options):
    found = lexical.ranked_search(frame(spark, docs).repartition(3), benchmark(spark, items), **options).collect()
    want = plain(docs, items, options.get("best", 20))
    assert sorted((tuple(r) for r in found), key=repr) == want
    return want


def corpus(seed, n):
    """Words as frequent as 1 / rank, in texts of all lengths; a third of them is one text."""
    pick = random.Random(seed)
    words = prose(seed, 400).split()
    odds = [1 / (k + 1) for k in range(len(words))]
    texts = [" ".join(pick.choices(words, odds, k=pick.choice([1, 3, 20, 60, 300]))) for _ in range(n)]
    return [(i, texts[0] if i % 3 == 0 else t) for i, t in enumerate(texts)], words, odds, pick


@pytest.mark.parametrize("best, block", [(20, 1 << 20), (3, 300)])
def test_beside_scoring_everything(spark, best, block):
    docs, words, odds, pick = corpus(1, 300)
    items = [(n, ", ".join(pick.choices(words, odds, k=pick.randint(1, 40)))) for n in range(12)]
    assert len(check(spark, docs, items, best=best, block_bytes=block)) == 12 * best


def test_odd_texts_and_items(spark):
    items = [
        (1, None),
        (2, ""),
        (3, "... !"),
        (4, "one ONE oNe"),
        (5, "Ünïcödé ünïcödé ß-中文 😀"),
        (6, odd_texts()[3][1]),
        (6, odd_texts()[8][1]),
        (7, "nowhere"),
        (None, "a b c"),
        (8, "a\x00b_c{d}e@f`g[h"),
    ]
    assert check(spark, odd_texts(), items)


def test_no_documents_no_items(spark):
    assert check(spark, [], [(1, "a")]) == []
    assert check(spark, [(1, "a")], []) == []
    assert check(spark, [(1, None), (2, "--")], [(1, "a")]) == []


def _shard(docs, items, best):
    queries = lexical.queries_of(list(range(len(items))), items)
    class Sent:
        value = queries.marks
    made = pa.Table.from_batches(lexical._forward(Sent)([pa.record_batch([pa.array([i for i, _ in docs]), pa.array([t for _, t in docs])], names=["doc_id", "text"])]))
    made_terms, often = (made[c].combine_chunks() for c in ("terms", "often"))
    n = np.asarray(made["n"])
    frequency = np.bincount(np.asarray(made_terms.flatten()), minlength=len(queries.marks))
    documents = int((n > 0).sum())
    stats = lexical.Statistics(documents, int(n.sum()), lexical.weights(documents, frequency), frequency)
    sizes = np.diff(np.asarray(made_terms.offsets))
    flat = [np.asarray(x.flatten()).astype(np.int64) for x in (made_terms, often)]
    return queries, lexical.Shard(np.asarray(made["doc_id"]), n, sizes, *flat, stats, lexical.pairs_of(queries, frequency), best)


def test_bounds_of_pairs_hold_and_skip_more():
    """No document gets more from a set of terms than its bound; with pairs fewer postings are read."""
    docs, words, odds, pick = corpus(2, 4_000)
    items = [" ".join(pick.choices(words, odds, k=25)) for _ in range(40)]
    queries, shard = _shard(docs, items, 5)
    read = [0, 0]
    for terms_of in queries.terms:
        order = sorted(terms_of, key=lambda t: (-terms_of[t] * int(shard.most[t]), t))
        sums = np.zeros(len(shard.ids), dtype=np.int64)
        with_pairs = lexical._bounds(shard, order, terms_of, True)
        singles = lexical._bounds(shard, order, terms_of, False)
        for at in reversed(range(len(order))):
            d, s = shard.list_of(order[at])
            sums[d] += terms_of[order[at]] * s
            assert sums.max() <= with_pairs[at] <= singles[at]
        found = [lexical.search(shard, terms_of, with_pairs=p) for p in (False, True)]
        for n, f in enumerate(found):
            read[n] += f.postings
        tops = [sorted(zip((-f.scores).tolist(), f.ids.tolist(), strict=True))[:5] for f in found]
        assert tops[0] == tops[1] == sorted((-s, i) for s, i in zip(sums.tolist(), shard.ids.tolist(), strict=True))[:5]
    full = sum(len(shard.list_of(t)[0]) for q in queries.terms for t in q)
    assert read[1] < read[0] < full
