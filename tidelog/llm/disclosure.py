"""Personal data, and terms that give it away.

Mail addresses, IP addresses, card and phone numbers are found by their form. The words around such an
entity are its context. Over the whole corpus it is estimated how much of an entity's information a
term reveals: their pointwise mutual information as a share of the entity's information content,
log2(N n_et / (n_e n_t)) / log2(N / n_e), where N is the number of documents, n_e those with the entity,
n_t those with the term anywhere, n_et those with it in a context of the entity. A share says little of
a term that many documents hold once N is large, so a term must also lead to the entity: n_et / (n_t + 1),
a cautious estimate of the entity's probability given the term, must reach `LEAST_POSTERIOR`.

Terms over a threshold are replaced by a general word, terms over a higher one removed: all of a document's
words that are such a term in a context of the document itself, or in the contexts of one of its entities
in at least one of `COMMON` documents with the entity. (The second kind are at most 16 x `COMMON` terms for
an entity with one place a document, so the work stays linear even if a third of all rows hold the entity.)
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.storage import store

KINDS = ("email", "ip", "card", "phone")
ADDED = ("generalised", "removed")
CONTEXT_WORDS = 8
LEAST_POSTERIOR = 0.2
COMMON = 20
GENERALISE_AT = 0.5
REMOVE_AT = 0.9

# The forms of personal data.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a search that fails at the first digit of a run fails at its other digits too
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DIGIT = re.compile(r"[0-9]")
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; each is found from its @, so that long runs of letters cost nothing."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def _luhn(digits: str) -> bool:
    total = 0
    for n, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of personal data by kind, then place, in code points."""
    found = [Span("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(x) <= 3 and int(x) <= 255 for x in (p.lstrip("0") or "0" for p in m[0].split("."))):
            found.append(Span("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(Span("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m[0])) <= 15:
                found.append(Span("phone", *m.span()))
    return found


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def term(word: str) -> str:
    """A word without marks at its edges and without case; empty if it is too short to tell anything."""
    plain = word.strip(_EDGES).casefold()
    return plain if len(plain) > 2 else ""


def entity(text: str, span: Span) -> str:
    value = text[span.start : span.end].casefold()
    return f"{span.kind}:{value if span.kind in ('email', 'ip') else ''.join(_DIGIT.findall(value))}"


def merged(spans: Iterable[Span]) -> list[tuple[int, int]]:
    """What the spans cover, in order and apart."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s.start, s.end) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def context(text: str, span: Span, covered: list[tuple[int, int]], words: int = CONTEXT_WORDS) -> list[str]:
    """The terms of the words before and after a span, in order; words that touch personal data are left out."""
    reach = 40 * words
    while True:
        low = max(0, span.start - reach)
        before = [(low + m.start(), low + m.end()) for m in _WORD.finditer(text[low : span.start])]
        if not low or len(before) > words:  # else the first may be cut
            break
        reach *= 2
    after = [m.span() for m in islice(_WORD.finditer(text, span.end), words)]
    out = []
    for a, b in [*before[-words:], *after]:
        at = bisect_right(covered, a, key=lambda c: c[1])
        if at == len(covered) or covered[at][0] >= b:
            out.append(term(text[a:b]))
    return [t for t in out if t]


_FOUND = (
    "row bigint, doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, "
    "text string, entities array<struct<entity string, terms array<string>>>, term string, n bigint"
)
_ENTITIES = pa.list_(pa.struct([("entity", pa.string()), ("terms", pa.list_(pa.string()))]))
_ARROW = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64())]
    + [(f"n_{k}", pa.int64()) for k in KINDS]
    + [("base", pa.string()), ("text", pa.string()), ("entities", _ENTITIES), ("term", pa.string()), ("n", pa.int64())]
)
_MOST_KNOWN = 100_000


class Frequencies:
    """In how many documents each term is, handed on before too many words are held."""

    def __init__(self, most: int = _MOST_KNOWN):
        self.most = most
        self.counts: Counter[str] = Counter()
        self.known: dict[bytes, str] = {}

    def add(self, text: str) -> None:
        known = self.known
        words = set(text.encode().split())  # bytes are parted at the same marks as words
        for word in words.difference(known):
            known[word] = term(word.decode())
        self.counts.update({known[w] for w in words})

    def full(self) -> bool:
        return len(self.known) >= self.most

    def hand_on(self) -> pa.RecordBatch:
        self.counts.pop("", None)
        found = [{"term": t, "n": n} for t, n in self.counts.items()]
        self.counts, self.known = Counter(), {}
        return pa.RecordBatch.from_pylist(found, schema=_ARROW)


def terms_of_entities(text: str, spans: list[Span], words: int = CONTEXT_WORDS) -> dict[str, set[str]]:
    """The terms in the contexts of each entity of a text."""
    covered, out = merged(spans), {}
    for s in spans:
        out.setdefault(entity(text, s), set()).update(context(text, s, covered, words))
    return out


def _find(words: int):
    """A row for each document, and rows that say how many documents of the task have a term."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        frequencies = Frequencies()
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                out = []
                for doc_id, value in zip(batch.column(0)[low : low + 1000], batch.column(1)[low : low + 1000], strict=True):
                    text = value.as_py() or ""
                    spans = base_spans(text)
                    row = {"row": number, "doc_id": doc_id.as_py(), "base": joined(spans)}
                    row |= {f"n_{k}": sum(s.kind == k for s in spans) for k in KINDS}
                    number += 1
                    if spans:
                        row["text"] = text
                        row["entities"] = [
                            {"entity": e, "terms": sorted(terms)} for e, terms in terms_of_entities(text, spans, words).items()
                        ]
                    out.append(row)
                    frequencies.add(text)
                    if frequencies.full():
                        yield frequencies.hand_on()
                yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
        yield frequencies.hand_on()

    return run


def general_word(word: str) -> str:
    """What a term is replaced by: a word for its kind."""
    return "[NUMBER]" if _DIGIT.search(word) else "[NAME]" if word[:1].isupper() else "[TERM]"


def added_spans(text: str, base: list[Span], terms: dict[str, float], remove_at: float) -> list[Span]:
    """Spans of the revealing terms outside the base spans, by kind and place."""
    covered = sorted((s.start, s.end) for s in base)
    found, at = [], 0
    for m in _WORD.finditer(text):
        strength = terms.get(term(m[0]))
        if strength is None:
            continue
        while at < len(covered) and covered[at][1] <= m.start():
            at += 1
        if any(a < m.end() for a, b in covered[at : at + 1]):
            continue
        found.append(Span("removed" if strength >= remove_at else "generalised", *m.span()))
    return sorted(found, key=lambda s: (ADDED.index(s.kind), s.start))


def sanitised(text: str, spans: Iterable[Span]) -> str:
    """The text with personal data named by its kind, terms generalised or removed."""
    out, last = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start < last:
            last = max(last, s.end)
            continue
        word = text[s.start : s.end]
        new = f"[{s.kind.upper()}]" if s.kind in KINDS else general_word(word) if s.kind == "generalised" else ""
        out += [text[last : s.start], new]
        last = s.end
    return "".join([*out, text[last:]])


def parsed(spans: str) -> list[Span]:
    parts = [x.split(":") for x in spans.split(",") if x]
    return [Span(kind, int(a), int(b)) for kind, a, b in parts]


_OUT = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    "base_sha256 string, spans string, sanitised string"
)


def _finish(remove_at: float):
    kinds = pa.schema(
        [("doc_id", pa.int64())]
        + [(f"n_{k}", pa.int64()) for k in KINDS]
        + [("base_sha256", pa.string()), ("spans", pa.string()), ("sanitised", pa.string())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                base, new, clean = parsed(row["base"]), [], None
                if row["text"] is not None:
                    terms = {x["term"]: x["disclosure"] for x in row["revealing"] or ()}
                    new = added_spans(row["text"], base, terms, remove_at) if terms else []
                    clean = sanitised(row["text"], [*base, *new])
                out.append(
                    {
                        "doc_id": row["doc_id"],
                        **{f"n_{k}": row[f"n_{k}"] for k in KINDS},
                        "base_sha256": hashlib.sha256(row["base"].encode()).hexdigest(),
                        "spans": joined([*base, *new]),
                        "sanitised": clean,
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=kinds)

    return run


def revealing_terms(
    contexts: DataFrame,
    frequencies: DataFrame,
    total: int,
    least_posterior: float = LEAST_POSTERIOR,
    least_disclosure: float = GENERALISE_AT,
) -> DataFrame:
    """(entity, term, disclosure, common) from (row, entity, terms), (term, n_t) and the number of documents.

    `contexts` has one row for each document and entity. An entity that is in every document has nothing to
    reveal. `common` says whether the term is in enough of the entity's contexts to hold for all documents
    with the entity.
    """
    entities = contexts.groupBy("entity").agg(F.count("*").alias("n_e"))
    pairs = contexts.select("entity", F.explode("terms").alias("term"))
    both = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_et"))
    n_t = F.greatest("n_t", "n_et")
    known = both.join(frequencies, "term").withColumn("n_t", n_t).filter(F.col("n_et") / (F.col("n_t") + 1) >= least_posterior)
    share = F.log2(F.lit(total) * F.col("n_et") / (F.col("n_e") * F.col("n_t"))) / F.log2(F.lit(total) / F.col("n_e"))
    return (
        known.join(entities, "entity")
        .filter(F.col("n_e") < total)
        .select("entity", "term", share.alias("disclosure"), (F.col("n_et") * COMMON >= F.col("n_e")).alias("common"))
        .filter(F.col("disclosure") >= least_disclosure)
    )


def find_personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    context_words: int = CONTEXT_WORDS,
    least_posterior: float = LEAST_POSTERIOR,
    generalise_at: float = GENERALISE_AT,
    remove_at: float = REMOVE_AT,
) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, sanitised), one row for each row of `docs`.

    A null text is an empty one. `sanitised` is null where there is no personal data. Repeated rows get
    the same result, and each counts as a document. An empty table gives an empty result. Other columns
    are not read, whatever their names.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    whole = store(rows.mapInArrow(_find(context_words), _FOUND), "personal").rows
    found = whole.filter("row is not null").drop("term", "n")
    contexts = found.filter("entities is not null").select("row", F.explode("entities").alias("e")).select("row", "e.*")
    frequencies = whole.filter("term is not null").groupBy("term").agg(F.sum("n").alias("n_t"))
    revealing = revealing_terms(contexts, frequencies, found.count(), least_posterior, generalise_at)
    revealing = store(revealing, "revealing").rows
    own = contexts.select("row", "entity", F.explode("terms").alias("term"))
    own = own.join(revealing.drop("common"), ["entity", "term"]).select("row", "term", "disclosure")
    common = revealing.filter("common").select("entity", "term", "disclosure")
    shared = contexts.select("row", "entity").join(common, "entity").select("row", "term", "disclosure")
    strongest = own.unionByName(shared).groupBy("row", "term").agg(F.max("disclosure").alias("disclosure"))
    of_row = strongest.groupBy("row").agg(F.collect_list(F.struct("term", "disclosure")).alias("revealing"))
    return found.drop("entities").join(of_row, "row", "left").mapInArrow(_finish(remove_at), _OUT)
