"""The thin queries opN_<name>: each applies its operator to its whole table and derives the digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.llm import bpe, decontam, dedup_exact, divergence, fim, langid, line_dedup, ngram_join, pii, sharding, suffix_dedup, toxicity, warc
from docspark.llm.common import load
from docspark.llm.registry import query

SHARDS = 24


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_warc_index")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.fetch(warc.archive(pages), pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# Windows of three lines, and of one or two lines with 50 words; later ones by (doc_id, line) are deleted with all their lines.
@query("op3_line_runs", r"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
               FROM documents WHERE text IS NOT NULL),
counted AS (SELECT *, len(regexp_extract_all(line, '[^ \t\n\x0B\f\r]+')) AS words FROM lines),
threes AS (SELECT doc_id, pos, line, words, lead(line, 1) OVER d AS l2, lead(line, 2) OVER d AS l3, lead(words, 1) OVER d AS words2 FROM counted
           WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
later AS (SELECT doc_id, pos, words >= 50 AND row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) > 1 AS copy1,
                 l2 IS NOT NULL AND words + words2 >= 50 AND row_number() OVER (PARTITION BY line, l2 ORDER BY doc_id, pos) > 1 AS copy2,
                 l3 IS NOT NULL AND row_number() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id, pos) > 1 AS copy FROM threes),
gone AS (SELECT doc_id, pos, coalesce(copy1, false) OR coalesce(copy2, false) OR coalesce(lag(copy2, 1) OVER d, false)
                OR coalesce(copy, false) OR coalesce(lag(copy, 1) OVER d, false) OR coalesce(lag(copy, 2) OVER d, false) AS g
         FROM later WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
runs AS (SELECT doc_id, pos, g, g AND NOT coalesce(lag(g) OVER (PARTITION BY doc_id ORDER BY pos), false) AS starts FROM gone)
SELECT documents.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (g) AS n_removed, count(*) FILTER (starts) AS n_runs,
         string_agg(line, chr(10) ORDER BY pos) FILTER (NOT g) AS kept
  FROM runs JOIN lines USING (doc_id, pos) GROUP BY doc_id) r ON r.doc_id = documents.doc_id""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.drop_repeated_lines(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


@query("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, path, pattern, keep_text=False)
    return bpe.decode(ids, path).select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query("op5_cross_parsing_langid")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    samples = langid.sample(docs.where(~langid.held_out("doc_id")).select("text", "lang"))
    return langid.identify(docs.select("doc_id", "text"), samples).select(
        "doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )


@query("op6_feistel_sharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return sharding.shuffle_rows(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op7_cgk_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query("op8_golomb_dedup", """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS s
           FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       s AS text_sha256
FROM d WINDOW g AS (PARTITION BY s)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = dedup_exact.exact_groups(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.withColumnRenamed("keep_key", "keep_id")


@query("op9_offset_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


@query("op10_ngram_trie_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_components(load(spark, sf_dir, "documents"))


@query("op11_piece_table_fim", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
units AS (SELECT *, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS u, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
                 ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM d),
cuts AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM units),
parts AS (SELECT doc_id, t, n, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cuts),
texts AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                              ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o FROM parts)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars, sha256(o) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN o
                        WHEN 'psm' THEN split_part(o[4:], '<S>', 1) || split_part(o, '<M>', 2) || split_part(split_part(o, '<S>', 2), '<M>', 1)
                        ELSE split_part(split_part(o, '<P>', 2), '<M>', 1) || split_part(o, '<M>', 2) || split_part(o[4:], '<P>', 1)
                        END) AS restored_sha256
FROM texts""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.transform(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return fim.restore(cut.drop("text"), keep_text=False).select(
        "doc_id", F.col("n_lines").alias("n"), "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


@query("op12_source_divergence", r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t, row_number() OVER () AS row FROM documents),
words AS (SELECT lang, source, row, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
found AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d)
           LEFT JOIN (SELECT lang, source, sum(n) AS total FROM found GROUP BY lang, source) USING (lang, source)),
p AS (SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(f.n, 0) + 5)) // (g.total + 5 * s.v) AS p,
             1 + (1000000000::HUGEINT * (k.n + 5)) // (s.total + 5 * s.v) AS q
      FROM groups g JOIN kept k ON g.lang = k.lang JOIN sizes s ON g.lang = s.lang
      LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(f, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source AS s1, y.source AS s2, sum(abs(x.p - y.p)) AS f FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
                     GROUP BY ALL) z ON z.lang = a.lang AND z.s1 = a.source AND z.s2 = b.source),
parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
         UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 50""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(load(spark, sf_dir, "documents"))


@query("op13_toxicity_trees")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs.where(~langid.held_out("doc_id")), labels)
    return toxicity.score(docs, model, keep_text=False).select("doc_id", langid.held_out("doc_id").alias("held_out"), "score", "predicted")
