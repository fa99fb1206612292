"""The numbered queries: each applies one operator to its whole table.

``QUERIES[name](spark, sf_dir)`` returns the digest columns of its contract;
``ORACLE[name]`` is DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, divergence, language, licenses, lines, manifest, mixing, packing, secrets, simhash,
               substrings, urls, vectors)
from .common import read_table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.match_benchmark(docs, read_table(spark, sf_dir, "benchmark"),
                                          keep=["doc_id"])
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(docs, keep=["doc_id"])
    base = F.filter("matches", lambda m: m["exact"])
    first = F.transform(base, lambda m: m["first_word"].cast("bigint"))

    def labels(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    score = F.transform("matches", lambda m: 1.0 - m["edits"] / F.length(m["notice"]))
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(score), F.lit(0.0)).alias("score"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_lines, n_removed, kept_sha256`` (SHA-256 of the lines left,
    joined by line feeds; of nothing for a null text)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.removed_lines(docs).select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_removed",
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, keep=["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, keep=["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", mixing.taken().alias("taken"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan_secrets(docs, keep=["doc_id"])

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        F.col("doc.doc_id").alias("doc_id"), of("assign").alias("n_assign"), of("access").alias("n_access"),
        of("hex").alias("n_hex"), F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.learn(docs), keep=["doc_id"])
    return found.select(F.col("doc.doc_id").alias("doc_id"), language.held_out("doc.doc_id").alias("held_out"),
                        "lang_pred", "score", "rejected")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    return pieces.select(F.col("doc.doc_id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens",
                         "sequence_id", "offset")


def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(*manifest.COLUMNS)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    made = manifest.build(docs, shown={"text": F.when(tampered, lowered).otherwise(F.col("text"))}, keep=["doc_id"])
    root = F.lit(made.root).cast("binary")

    def text(digest):
        return F.lower(F.hex(digest))

    return manifest.prove(made).select(
        F.col("doc.doc_id").alias("doc_id"), text("leaf").alias("leaf"), text("subroot").alias("subroot"),
        text(root).alias("root"), text("proof_sha256").alias("proof_sha256"), text("folded_root").alias("folded_root"),
        (F.col("folded_root") == root).alias("verified"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_line_dedup": op5_line_dedup,
    "op6_simhash": op6_simhash,
    "op7_url_filter": op7_url_filter,
    "op8_mix": op8_mix,
    "op9_secret_scan": op9_secret_scan,
    "op10_language_id": op10_language_id,
    "op11_packing": op11_packing,
    "op12_divergence_audit": op12_divergence_audit,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op1_decontaminate": rf"""
WITH dw AS (
  SELECT doc_id, coalesce(regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), bw AS (
  SELECT item_id, coalesce(regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
  FROM bw, LATERAL (SELECT unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i)
  WHERE len(w) > 0
), lens AS (SELECT DISTINCT n FROM win
), place AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM dw, lens, LATERAL (SELECT unnest(generate_series(1, len(w) - n + 1)) AS i)
  WHERE len(w) >= n
), met AS (SELECT p.doc_id, p.n, p.i, win.item_id FROM place p JOIN win USING (n, s)
), hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM met, LATERAL (SELECT unnest(generate_series(i, i + n - 1)) AS k) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op2_substring_dedup": r"""
WITH dw AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), win AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS s
  FROM dw, LATERAL (SELECT unnest(generate_series(1, len(w) - 49)) AS i) WHERE len(w) >= 50
), least AS (SELECT s, min(doc_id) AS d FROM win GROUP BY s
), gone AS (
  SELECT DISTINCT win.doc_id, k FROM win JOIN least USING (s),
         LATERAL (SELECT unnest(generate_series(i, i + 49)) AS k) WHERE least.d < win.doc_id
), word AS (
  SELECT doc_id, k, w[k] AS w FROM dw, LATERAL (SELECT unnest(generate_series(1, len(w))) AS k)
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY k) AS t
  FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM dw LEFT JOIN kept USING (doc_id)
""",
    "op3_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[64]) AS e FROM embeddings
), pair AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE array_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, pair.b FROM reach JOIN pair ON pair.a = reach.b
), comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a
), deg AS (SELECT a, count(*) AS n FROM pair GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept
FROM v JOIN comp ON comp.a = vec_id LEFT JOIN deg ON deg.a = vec_id
""",
    "op5_line_dedup": rf"""
WITH ln AS (
  SELECT doc_id, i, l[i] AS line,
         list_distinct(regexp_extract_all(l[i], '[^\x20\x09-\x0D]+')) AS w
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
       LATERAL (SELECT unnest(generate_series(1, len(l))) AS i)
), one AS (
  SELECT min(struct_pack(d := doc_id, i := i)) AS k, list_sort(w) AS w FROM ln WHERE len(w) > 0 GROUP BY list_sort(w)
), word AS (SELECT k, len(w) AS n, unnest(w) AS t FROM one
), freq AS (SELECT t, count(*) AS c FROM word GROUP BY t
), pre AS (
  SELECT k, n, t FROM (SELECT k, n, word.t, row_number() OVER (PARTITION BY k ORDER BY c, word.t) AS r
                        FROM word JOIN freq USING (t)) WHERE r <= n - (4 * n + 4) // 5 + 1
), pair AS (
  SELECT DISTINCT a.k AS x, b.k AS y FROM pre a JOIN pre b ON a.t = b.t AND b.k < a.k
  WHERE 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
), sim AS (
  SELECT DISTINCT x FROM pair JOIN one p ON p.k = x JOIN one q ON q.k = y
  WHERE 5 * len(list_intersect(p.w, q.w)) >=
        4 * (len(p.w) + len(q.w) - len(list_intersect(p.w, q.w)))
), judged AS (
  SELECT ln.doc_id, ln.i, ln.line,
         len(ln.w) = 0 OR (one.k IS NOT NULL AND sim.x IS NULL) AS stays
  FROM ln LEFT JOIN one ON one.k = struct_pack(d := ln.doc_id, i := ln.i) LEFT JOIN sim ON sim.x = one.k
)
SELECT doc_id, CAST(count(line) AS BIGINT) AS n_lines, CAST(coalesce(sum(CASE WHEN NOT stays THEN 1 END), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE stays), '')) AS kept_sha256
FROM documents LEFT JOIN judged USING (doc_id) GROUP BY doc_id
""",
    "op12_divergence_audit": rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), kept AS (
  SELECT lang, t FROM (SELECT lang, unnest(list_distinct(w)) AS t FROM d) GROUP BY lang, t HAVING count(*) >= 10
), size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang
), occ AS (
  SELECT lang, source, t, count(*) AS n FROM (SELECT lang, source, unnest(w) AS t FROM d) JOIN kept USING (lang, t)
  GROUP BY lang, source, t
), grp AS (SELECT DISTINCT lang, source FROM d
), whole AS (SELECT lang, t, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM occ GROUP BY lang, t
), tot AS (SELECT lang, source, sum(n) AS total FROM occ GROUP BY lang, source
), dense AS (
  SELECT g.lang, g.source, k.t, coalesce(o.n, 0) AS n,
         1 + (1000000000 * (coalesce(o.n, 0) + 2)::HUGEINT) // (coalesce(tot.total, 0) + 2 * s.v)::HUGEINT AS p,
         1 + (1000000000 * (w.n + 2)::HUGEINT) // (w.total + 2 * s.v)::HUGEINT AS q
  FROM grp g JOIN kept k USING (lang) JOIN size s USING (lang) JOIN whole w USING (lang, t)
  LEFT JOIN occ o USING (lang, source, t) LEFT JOIN tot USING (lang, source)
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL
), every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', t, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM dense WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
""",
    "op13_merkle_manifest": """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, text,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
         list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))) AS flipped
  FROM documents
), leaf AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN xor(flipped, 4294967295) % 3 = 0
              THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
         END AS shown
  FROM d
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM leaf
), low AS (
  SELECT tree, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY tree
  UNION ALL
  SELECT tree, level + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1:i + 8], '')))
  FROM low WHERE len(nodes) > 1
), high AS (
  SELECT 0 AS level, list(nodes[1] ORDER BY tree) AS nodes FROM low WHERE len(nodes) = 1
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1:i + 8], '')))
  FROM high WHERE len(nodes) > 1
), step AS (
  SELECT tree, level, nodes FROM low WHERE len(nodes) > 1
  UNION ALL
  SELECT low.tree, low.level + high.level, high.nodes
  FROM low, high WHERE len(low.nodes) = 1 AND len(high.nodes) > 1
), subroot AS (SELECT tree, level AS depth, nodes[1] AS subroot FROM low WHERE len(nodes) = 1
), root AS (SELECT nodes[1] AS root FROM high WHERE len(nodes) = 1
), walk AS (
  SELECT doc_id, tree, depth, 0 AS level, CASE WHEN depth = 0 THEN tree ELSE place END AS pos, leaf,
         coalesce(shown, leaf) AS cur, '' AS proof
  FROM placed JOIN subroot USING (tree)
  UNION ALL
  SELECT doc_id, tree, depth, level + 1, CASE WHEN level + 1 = depth THEN tree ELSE pos // 8 END, leaf,
         sha256(array_to_string(nodes[pos - pos % 8 + 1:pos], '') || cur || array_to_string(nodes[pos + 2:pos - pos % 8 + 8], '')),
         proof || array_to_string(nodes[pos - pos % 8 + 1:pos], '') || array_to_string(nodes[pos + 2:pos - pos % 8 + 8], '')
  FROM walk JOIN step USING (tree, level)
), top AS (SELECT tree, coalesce(max(step.level) + 1, 0) AS level FROM subroot LEFT JOIN step USING (tree) GROUP BY tree)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM walk JOIN top USING (tree, level) JOIN subroot USING (tree), root
""",
}
