"""The registered queries of the operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.llm import (
    decontaminate,
    disclosure,
    exact,
    lattice,
    lexical,
    minhash,
    mixing,
    negatives,
    quality,
    repeated,
    scaled,
    tokens,
    warc,
)
from tidelog.llm.registry import query, table
from tidelog.session import work_dir

OP8_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query("op8_exact_dedup", OP8_SQL)
def op8_exact_dedup(spark, sf_dir):
    return exact.exact_groups(table(spark, sf_dir, "documents"))


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda i:
    list_aggregate(list_transform([15, 10, 5, 0], lambda s:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             CAST((CAST('0x' || substr(hex, CAST(i * 5 + 1 AS INT), 5) AS BIGINT) >> s) & 31 AS INT) + 1, 1)),
      'string_agg', '')), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM g
"""


@query("op3_warc", OP3_SQL)
def op3_warc(spark, sf_dir):
    index = warc.write_archives(table(spark, sf_dir, "pages"), warc.new_folder(spark))
    records = warc.read_archives(index.rows, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_token_ids")
def op10_token_ids(spark, sf_dir):
    path = work_dir(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path)
    return tokens.checksums(tokens.read_tokens(spark, path)).select(
        "doc_id", "start", "n_tokens", F.col("ids_crc32")
    )


@query("op7_quality")
def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model, known = quality.learned(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(known, model, places_col="places")
    return scored.select(
        "doc_id",
        F.coalesce(quality.fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op1_mixing")
def op1_mixing(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rates, _ = mixing.mixed_rates(docs, labels)
    posterior = [F.round(F.col("posterior")[n], 6).alias(f"p_{d}") for n, d in enumerate(mixing.TARGETS)]
    return rates.select(
        "doc_id", "n_tokens", *posterior, F.round("rate", 6).alias("rate"), mixing.copies("rate", "doc_id").alias("copies")
    )


@query("op5_personal_data")
def op5_personal_data(spark, sf_dir):
    return disclosure.find_personal_data(table(spark, sf_dir, "documents")).drop("sanitised")


OP6_SQL = """
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'),
                                       lambda w: w <> '') AS w FROM documents),
bw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'),
                                   lambda w: w <> '') AS w FROM benchmark),
d AS (SELECT doc_id, len(w) AS n, CASE WHEN len(w) >= 5 THEN
        list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
        ELSE ['< ' || array_to_string(w, ' ')] END AS marks FROM dw WHERE len(w) > 0),
b AS (SELECT item_id, len(w) AS size, CASE WHEN len(w) >= 5 THEN
        list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
        ELSE ['< ' || array_to_string(w, ' ')] END AS marks FROM bw WHERE len(w) > 0),
dm AS (SELECT doc_id, n, unnest(marks) AS mark, unnest(range(0, len(marks))) AS p FROM d),
bm AS (SELECT DISTINCT size, unnest(marks) AS mark, unnest(range(0, len(marks))) AS place FROM b),
win AS (SELECT DISTINCT doc_id, size, greatest(0, least(p - place, n - size)) AS pos FROM dm JOIN bm USING (mark)),
cut AS (SELECT doc_id, pos, size, unnest(marks[pos + 1 : pos + greatest(size - 4, 1)]) AS mark FROM win JOIN d USING (doc_id)),
wc AS (SELECT doc_id, pos, size, mark, count(*) AS c FROM cut GROUP BY ALL),
wt AS (SELECT doc_id, pos, size, sum(c) AS total FROM wc GROUP BY ALL),
ic AS (SELECT item_id, size, mark, count(*) AS c FROM (SELECT item_id, size, unnest(marks) AS mark FROM b) GROUP BY ALL),
it AS (SELECT item_id, sum(c) AS total FROM ic GROUP BY ALL),
inter AS (SELECT doc_id, pos, size, item_id, sum(least(wc.c, ic.c)) AS shared FROM wc JOIN ic USING (size, mark) GROUP BY ALL),
sim AS (SELECT doc_id, pos, item_id, shared / (wt.total + it.total - shared) AS similarity
        FROM inter JOIN wt USING (doc_id, pos, size) JOIN it USING (item_id)),
best AS (SELECT doc_id, arg_max({item_id: item_id, similarity: similarity, pos: pos}, (similarity, -item_id, -pos)) AS b
         FROM sim WHERE similarity >= 0.75 GROUP BY doc_id)
SELECT doc_id, b IS NOT NULL AS contaminated, b.item_id AS item_id, round(b.similarity, 6) AS similarity, b.pos AS start_word
FROM documents LEFT JOIN best USING (doc_id)
"""


@query("op6_decontaminate", OP6_SQL)
def op6_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "item_id", F.round("similarity", 6).alias("similarity"), F.col("at").alias("start_word"))


OP9_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
    lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN ['< ' || array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END) AS mark FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y USING (mark)
    WHERE x.doc_id < y.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
    WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT a, b FROM edges UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.other = edges.a),
least AS (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(least.least, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(least.least, doc_id)) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""


@query("op9_minhash", OP9_SQL)
def op9_minhash(spark, sf_dir):
    return minhash.near_groups(table(spark, sf_dir, "documents")).drop("row")


OP2_SQL = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
           FROM documents),
wins AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS pos, w FROM d WHERE len(w) >= 35),
keyed AS MATERIALIZED (SELECT doc_id, pos, md5(array_to_string(w[pos:pos+34], ' ')) AS k FROM wins),
again AS (SELECT doc_id, pos FROM keyed WHERE k IN (SELECT k FROM keyed GROUP BY k HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, pos + unnest(range(0, 35)) AS p FROM again),
lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (SELECT doc_id, w, coalesce(len(ps), 0) AS n_removed,
    CASE WHEN ps IS NULL THEN w ELSE list_transform(
        list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(ps, i)), lambda i: w[i]) END AS left_words
    FROM d LEFT JOIN lists USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(array_to_string(left_words, ' ')) AS kept_sha256 FROM kept
"""


@query("op2_substring_dedup", OP2_SQL)
def op2_substring_dedup(spark, sf_dir):
    found = repeated.without_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op4_lattice")
def op4_lattice(spark, sf_dir):
    return lattice.lattice_scores(table(spark, sf_dir, "documents"))


@query("op11_scaled_sketch")
def op11_scaled_sketch(spark, sf_dir):
    return scaled.scaled_fingerprints(table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS MATERIALIZED (
  SELECT a.no, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.no <> b.no),
pos AS (SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, vec_id) AS place FROM met WHERE same QUALIFY place <= 5),
neg AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.no, p.place ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM pos p JOIN met n ON n.no = p.no AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
"""


@query("op12_hard_negatives", OP12_SQL)
def op12_hard_negatives(spark, sf_dir):
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents),
b AS (SELECT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
q AS MATERIALIZED (SELECT item_id, term, count(*) AS often FROM b GROUP BY ALL),
total AS MATERIALIZED (SELECT count(*) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM d WHERE len(t) > 0),
tf AS MATERIALIZED (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, total GROUP BY term),
m AS (SELECT row, doc_id, 100 - 25 + ((25 * len(t) * docs) // terms) AS m FROM d, total WHERE len(t) > 0),
s AS (SELECT item_id, row, any_value(doc_id) AS doc_id,
        CAST(sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM tf JOIN w USING (term) JOIN m USING (row) JOIN q USING (term) GROUP BY item_id, row)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""


@query("op13_ranked_search", OP13_SQL)
def op13_ranked_search(spark, sf_dir):
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
