import hashlib
from collections import defaultdict

import pytest

from tests.llm.conftest import odd_texts
from tidelog.llm.exact import exact_groups, name_texts


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        stays = True
        for i in ids:
            kept = i == keep and stays
            stays = stays and not kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [7, 2048])
def test_groups(odd, block_bytes):
    got = exact_groups(odd, block_bytes=block_bytes).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(odd_texts())


def test_no_rows(nothing):
    assert exact_groups(nothing).collect() == []


def test_names_tell_texts_apart_that_share_all_blocks(spark):
    texts = ["abab", "ab", "ba", "abba", "ababab", "aabb", "aa", "a", "abab"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    names = {r["doc_id"]: (r["rounds"], r["name"]) for r in name_texts(rows, block_bytes=2).collect()}
    assert len(set(names.values())) == len(set(texts))
    assert names[0] == names[8]
