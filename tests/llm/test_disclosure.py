import hashlib
import math
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import frame, odd_texts, prose
from tidelog.llm import disclosure as d

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for n, c in enumerate(digits[::-1]):
        x = int(c) * (2 if n % 2 else 1)
        total += x if x < 10 else x - 9
    return total % 10 == 0


def brute(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@-+ (_9é0", max_size=40))
def test_spans_are_the_leftmost_matches(text):
    assert [tuple(s) for s in d.base_spans(text)] == brute(text)


def test_known_forms():
    text = "é a.b@c.d_e@f.gh 1.2.3.4.5.6.7.8 256.1.1.1 4539 1488 0343 6467 x4539148803436467 +1 (017) 555-7713 +12"
    assert [tuple(s) for s in d.base_spans(text)] == brute(text)
    assert {s.kind for s in d.base_spans(text)} == {"email", "ip", "card", "phone"}
    assert d.base_spans("1" * 100_000 + "@") == [] and d.base_spans("a" * 200_000) == []
    assert d.base_spans("9" * 5000 + ".1.1.1") == []


def test_odd_texts(odd):
    got = d.find_personal_data(odd).collect()
    assert len(got) == len(odd_texts()) and all(r["spans"] == "" and r["sanitised"] is None for r in got)
    assert {r["base_sha256"] for r in got} == {hashlib.sha256(b"").hexdigest()}


def test_no_rows(nothing):
    assert d.find_personal_data(nothing).collect() == []


def corpus():
    """An address beside the same rare word in several texts; other addresses beside common words."""
    own = [f"own{prose(n, 3).replace(' ', '')}" for n in range(40)]
    rows = [(i, f"{own[i]} the of Quorndon ann@x.org and {own[i]}. Later on Quorndon, the") for i in range(6)]
    rows += [(50 + i, f"the of and with {own[6 + i]} m{i}@y.org the of on") for i in range(30)]
    rows += [(90 + i, "copy the rareword bob@z.org") for i in range(5)]
    rows += [(99, "Quorndon is a village of no one"), (100, None)]
    return rows


def test_terms_that_reveal_an_entity(spark):
    """Quorndon is in the six documents of one address and in one other; "the" is in many."""
    rows = corpus()
    got = {r["doc_id"]: r for r in d.find_personal_data(frame(spark, rows)).collect()}
    for i, text in rows:
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(text or ""))
        assert got[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert got[i]["spans"].startswith(base)
    for i in range(6):
        added = [s for s in d.parsed(got[i]["spans"]) if s.kind in d.ADDED]
        assert [(rows[i][1][s.start : s.end], s.kind) for s in added if "Quorndon" in rows[i][1][s.start : s.end]] == [
            ("Quorndon", "removed"),
            ("Quorndon,", "removed"),
        ]
        assert not {"the", "and"} & {rows[i][1][s.start : s.end] for s in added}
        assert "Quorndon" not in got[i]["sanitised"] and "[EMAIL]" in got[i]["sanitised"]
    assert got[99]["spans"] == "" and "rareword" not in got[90]["sanitised"]


def test_equal_contexts_in_several_documents_and_terms_with_digits(spark):
    """A signature that is the same in six documents, with a customer number."""
    block = "Yours Tilda Quorn ann@x.org customer K4471-09 phone +1 (017) 555-7713"
    rows = [(i, f"{prose(700 + i, 20)} {block} {prose(800 + i, 20)}") for i in range(6)]
    rows += [(50 + i, f"{prose(900 + i, 10)} m{i}@y.org {prose(950 + i, 10)}") for i in range(30)]
    got = {r["doc_id"]: r for r in d.find_personal_data(frame(spark, rows)).collect()}
    for i in range(6):
        added = {rows[i][1][s.start : s.end]: s.kind for s in d.parsed(got[i]["spans"]) if s.kind in d.ADDED}
        assert added.get("Quorn") == added.get("K4471-09") == "removed"
        assert not {"Quorn", "K4471-09", "555-7713"} & set(got[i]["sanitised"].split())


def test_words_of_a_context_are_whole():
    long = "q" * 1000
    text = f"first {long} a@b.cd {long} 1.2.3.4 last"
    spans = d.base_spans(text)
    assert d.context(text, spans[0], d.merged(spans)) == ["first", long, long, "last"]


def test_generalised_terms():
    spans = [d.Span("email", 0, 5), d.Span("generalised", 6, 10), d.Span("removed", 11, 15)]
    assert d.sanitised("a@b.c Rome wine end", spans) == "[EMAIL] [NAME]  end"


def brute_terms(rows, least_posterior=d.LEAST_POSTERIOR, least=d.GENERALISE_AT):
    """The strength of each revealing term of each row, in plain Python over all rows."""
    total, held, n_t = len(rows), [], Counter()
    for _, text in rows:
        text = text or ""
        n_t.update({d.term(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)})
        held.append(d.terms_of_entities(text, [d.Span(*s) for s in brute(text)]))
    n_e = Counter(e for x in held for e in x)
    n_et = Counter((e, t) for x in held for e, terms in x.items() for t in terms)
    out = []
    for x in held:
        strong = {}
        for (e, t), n in n_et.items():
            if e not in x or n_e[e] == total or not (t in x[e] or n * d.COMMON >= n_e[e]) or not n_t[t]:
                continue
            of = max(n_t[t], n)
            share = math.log2(total * n / (n_e[e] * of)) / math.log2(total / n_e[e])
            if share >= least and n / (of + 1) >= least_posterior:
                strong[t] = max(strong.get(t, 0), share)
        out.append(strong)
    return out


def planted():
    """Names beside addresses of one or two documents, far from them too; words beside them that are everywhere."""
    pick = random.Random(5)
    common = [f"word{n}" for n in range(60)]

    def filler(n):
        return " ".join(pick.choices(common, k=n))

    rows, names = [], {}
    for i in range(60):
        name, address = f"Quorn{i // 2}el", f"{'mn'[i % 2] * 3}{i // 2}@x.org" if i < 20 else f"z{i // 2}@x.org"
        names[i] = name
        rows.append((i, f"{name}: {filler(30)} now {name} {address} {filler(40)}"))
    rows += [(100 + i, f"{filler(40)} now {filler(3)}") for i in range(300)]
    rows += [(500, rows[40][1]), (501, None), (502, "")]
    return rows, names


def test_names_of_rare_entities_are_caught_and_frequent_words_stay(spark):
    rows, names = planted()
    got = {r["doc_id"]: r for r in d.find_personal_data(frame(spark, rows)).collect()}
    caught = sum(name not in got[i]["sanitised"] for i, name in names.items())
    assert caught >= 0.9 * len(names)
    for _, text in rows:
        assert text is None or not text or "now" in text
    assert all(" now " in r["sanitised"] for r in got.values() if r["sanitised"])
    for (i, text), strong in zip(rows, brute_terms(rows), strict=True):
        spans = [d.Span(*s) for s in brute(text or "")]
        assert got[i]["spans"] == d.joined([*spans, *d.added_spans(text or "", spans, strong, d.REMOVE_AT)])


def test_frequencies_are_handed_on():
    counts = d.Frequencies(most=6)
    counts.add("One one, two ! \u2003x")
    assert not counts.full()
    counts.add("one three four")
    assert counts.full()
    assert {r["term"]: r["n"] for r in counts.hand_on().to_pylist()} == {"one": 2, "two": 1, "three": 1, "four": 1}
    assert counts.hand_on().num_rows == 0
