"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from presscheck.llm import (
    decontamination,
    fingerprints,
    html_extraction,
    language,
    language_model,
    line_dedup,
    near_duplicates,
    packing,
    prefix_trie,
    suffixes,
    token_files,
    toxicity,
    whitening,
)
from presscheck.llm.tables import scratch_path, table
from presscheck.operators.once import compute_once


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark, folder):
    """Documents against themselves with the last third replaced by their neighbour's start."""
    rows = fingerprints.with_next(table(spark, folder, "documents"), "doc_id", "text")
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.left("text", F.length("text") - third), F.left("next_text", third))
    rows = compute_once(rows, {"edited": edited})
    rows = compute_once(rows, {"edited_sketch": fingerprints.fingerprint(F.col("edited"))})
    return rows.select(
        F.col("_key").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        fingerprints.shingle_count(F.col("sketch")).alias("n_shingles_estimate"),
    )


def op2_toxicity(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, table(spark, folder, "labels"))
    return toxicity.score(documents, model, carry=["doc_id"]).withColumn(
        "rejected", F.col("toxic_probability") >= 0.5
    )


def op3_suffix_dedup(spark, folder):
    kept = suffixes.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_line_dedup(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text", F.col("text").alias("whole"))
    lines = F.size(F.split("whole", "\n", -1))
    removed = F.aggregate("runs", F.lit(0), lambda n, run: n + run["end"] - run["start"])
    return line_dedup.remove_repeats(documents, runs="runs").select(
        "doc_id",
        F.when(F.col("whole").isNotNull(), lines).cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.when(F.col("runs").isNotNull(), F.size("runs")), F.lit(0)).cast("long").alias("n_runs"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op5_packing(spark, folder):
    sequences = packing.pack(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))
    return packing.piece_digests(sequences)


def op6_language(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(documents.where(_remainder(3) != 1))
    found = language.detect(documents.select("doc_id", "text"), model, carry=["doc_id"])
    return found.select(
        "doc_id",
        (_remainder(3) == 1).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        "language.score",
    )


def op7_benchmark_decontamination(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.find(documents, table(spark, folder, "benchmark"), carry=["doc_id"])
    overlap = F.col(decontamination.FOUND)
    names = F.sort_array(F.transform(overlap["items"], lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        overlap["n_words"].alias("n_words"),
        overlap["n_hit"].alias("n_hit"),
        F.size(overlap["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (overlap["n_hit"] > 0).alias("contaminated"),
    )


def op8_token_files(spark, folder):
    path = scratch_path(spark, "tokens")
    token_files.write(table(spark, folder, "documents"), path, vocabulary("word_bpe_49k.json"))
    return token_files.digests(token_files.read(spark, path))


def op9_near_duplicates(spark, folder):
    return near_duplicates.find(table(spark, folder, "documents"), width=2, percent=80)


def _remainder(divisor: int):
    """The checksum of the key, as text, by a divisor."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % divisor


def op10_language_model(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = language_model.fit(documents.where(_remainder(7) != 2))
    scored = language_model.score(documents, model, carry=["doc_id"])
    return scored.select(
        "doc_id",
        (_remainder(7) == 2).alias("held_out"),
        "lm.n_tokens",
        "lm.n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "lm.base_score",
        "lm.score",
        "lm.bigram_score",
    )


def op11_html_extraction(spark, folder):
    pages = table(spark, folder, "pages")
    texts = html_extraction.extract(pages, html_extraction.fit(pages), carry=["page_id", "url"])
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op12_whitening(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_prefix_trie(spark, folder):
    """Conversations that begin with up to five turns of the first of their hundred."""
    lists = prefix_trie.turn_lists(table(spark, folder, "conversations"), "conv_id", "turn", "role", "text")
    key = F.col("conv_id")
    length = F.crc32(key.cast("string").cast("binary")) % 6
    return prefix_trie.nodes(prefix_trie.with_head(lists, key - key % 100, length, 5))


QUERIES = {
    q.__name__: q
    for q in (
        op1_fingerprints,
        op2_toxicity,
        op3_suffix_dedup,
        op4_line_dedup,
        op5_packing,
        op6_language,
        op7_benchmark_decontamination,
        op8_token_files,
        op9_near_duplicates,
        op10_language_model,
        op11_html_extraction,
        op12_whitening,
        op13_prefix_trie,
    )
}

# SQL for DuckDB.

_OP4 = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
win AS (
  SELECT doc_id, i, n, array_to_string(w, chr(10)) AS k
  FROM (
    SELECT doc_id, i, n, l[i:i + n - 1] AS w
    FROM (SELECT doc_id, l, unnest(generate_series(1, len(l))) AS i FROM d), (VALUES (1), (2), (3)) sizes(n)
    WHERE i + n - 1 <= len(l))
  WHERE n = 3 OR len(regexp_extract_all(array_to_string(w, chr(10)), '[^ \t-\r]+')) >= 50
    OR n = 1 AND octet_length(encode(w[1])) >= 200),
seen AS (SELECT *, row_number() OVER (PARTITION BY n, k ORDER BY doc_id, i) AS r FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS j FROM seen WHERE r > 1),
runs AS (
  SELECT doc_id, count(*) AS n_removed, count(DISTINCT g) AS n_runs
  FROM (SELECT doc_id, j, j - row_number() OVER (PARTITION BY doc_id ORDER BY j) AS g FROM gone) GROUP BY 1),
kept AS (
  SELECT doc_id, string_agg(x, chr(10) ORDER BY i) AS t
  FROM (SELECT doc_id, i, l[i] AS x FROM (SELECT doc_id, l, unnest(generate_series(1, len(l))) AS i FROM d)) a
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = a.doc_id AND gone.j = a.i) GROUP BY 1)
SELECT d.doc_id, len(l) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
  CASE WHEN text IS NOT NULL THEN sha256(coalesce(t, '')) END AS kept_sha256
FROM d LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_OP7 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
i AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT item_id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS p FROM i)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT doc_id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, dw.n, p FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM (SELECT DISTINCT doc_id, n, p FROM hits)) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP9 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, w[i] || coalesce(' ' || w[i + 1], '') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 1, least(len(w), 1)))) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n + nb.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, edge.b FROM reach JOIN edge ON reach.other = edge.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) m USING (doc_id)
"""

_OP13 = r"""
WITH c AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
k AS (
  SELECT *, xor(4294967295, list_reduce(
    [4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda z: CAST(ascii(z) AS BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
  FROM c),
r AS (
  SELECT k.conv_id, coalesce(b.own[1:k.h], []) || k.own[k.h + 1:] AS s
  FROM k LEFT JOIN c b ON b.conv_id = k.conv_id - k.conv_id % 100),
p AS (SELECT conv_id, s[1:d] AS q, d, len(s) = d AS ends FROM (SELECT conv_id, s, unnest(generate_series(0, len(s))) AS d FROM r)),
n AS (
  SELECT q, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS e
  FROM p GROUP BY 1, 2),
kids AS (SELECT q[1:d - 1] AS q, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
own AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
    CASE WHEN d > 0 THEN (n_convs - 1) * length(n.q[d].t) ELSE 0 END AS saved
  FROM n LEFT JOIN kids ON kids.q = n.q),
up AS (SELECT q[1:a] AS q, n_children, saved FROM (SELECT *, unnest(generate_series(0, d)) AS a FROM own)),
sums AS (SELECT q, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY 1)
SELECT own.conv_id, own.d AS depth, parent.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(own.e) AS ends_sha256
FROM own JOIN sums ON sums.q = own.q LEFT JOIN n parent ON own.d > 0 AND parent.d = own.d - 1 AND parent.q = own.q[1:own.d - 1]
"""

ORACLES = {"op13_prefix_trie": _OP13, "op4_line_dedup": _OP4, "op7_benchmark_decontamination": _OP7, "op9_near_duplicates": _OP9}
