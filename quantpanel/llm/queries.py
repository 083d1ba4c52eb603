"""The registered queries of the text operators, each over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantpanel.llm.best_fit import pack_best_fit
from quantpanel.llm.decontamination import contaminated
from quantpanel.llm.filter_audit import filter_audit
from quantpanel.llm.language import held_out_languages
from quantpanel.llm.licenses import scan_licences
from quantpanel.llm.line_dedup import remove_repeated_lines
from quantpanel.llm.merkle import audited
from quantpanel.llm.packing import pack
from quantpanel.llm.phrases import removal_digests
from quantpanel.llm.rows import read_documents
from quantpanel.llm.simhash import fingerprint_components
from quantpanel.llm.stream_dedup import exact_groups
from quantpanel.llm.token_counts import token_counts
from quantpanel.llm.toxicity import held_out_toxicity

TRIGGER_BYTES = 4 << 30  # of one micro-batch of op6

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(
        read_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_lines(read_documents(spark, sf_dir))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source, language and a thousand ids to a directory."""
    part = (F.col("doc_id") / 1000).cast("long").cast("string")
    path = F.concat_ws("/", "source", "lang", part, F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    files = read_documents(spark, sf_dir).withColumn("path", path)
    return scan_licences(files, any_file=True)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(read_documents(spark, sf_dir), items)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    arriving = (
        spark.readStream.schema(docs.schema)
        .option("maxBytesPerTrigger", TRIGGER_BYTES)
        .parquet(f"{sf_dir}/documents{{.parquet}}")  # a pattern: the table may be one file
    )
    return exact_groups(docs, arriving)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_components(read_documents(spark, sf_dir))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_languages(read_documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return held_out_toxicity(read_documents(spark, sf_dir), labels)


def op10_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(read_documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(read_documents(spark, sf_dir))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_packing": op2_packing,
    "op3_line_dedup": op3_line_dedup,
    "op4_licences": op4_licences,
    "op5_decontamination": op5_decontamination,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_simhash": op7_simhash,
    "op8_language": op8_language,
    "op9_toxicity": op9_toxicity,
    "op10_repeated_phrases": op10_repeated_phrases,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_filter_audit": op12_filter_audit,
    "op13_best_fit": op13_best_fit,
}

SQL: dict[str, str] = {
    "op3_line_dedup": """
        WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
        w AS (
          SELECT doc_id, i, ls[i] || chr(10) || ls[i + 1] || chr(10) || ls[i + 2] AS run
          FROM d, unnest(range(1, len(ls) - 1)) AS t(i)),
        later AS (
          SELECT doc_id, i FROM w
          QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, i) > 1),
        gone AS (SELECT DISTINCT doc_id, i + k AS j FROM later, range(0, 3) AS r(k)),
        lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS j FROM d),
        kept AS (
          SELECT doc_id, string_agg(line, chr(10) ORDER BY j) AS kept, count(*) AS n
          FROM lines ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
        SELECT doc_id, coalesce(len(ls), 0) AS n_lines,
               coalesce(len(ls), 0) - coalesce(n, 0) AS n_removed,
               CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op5_decontamination": r"""
        WITH rows AS (
          SELECT 'd' AS kind, doc_id AS id, text FROM documents
          UNION ALL SELECT 'i', item_id, text FROM benchmark),
        w AS (
          SELECT kind, id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS ws
          FROM rows),
        s AS MATERIALIZED (
          SELECT DISTINCT kind, id, array_to_string(ws[i:i + 4], ' ') AS shingle
          FROM w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS t(i) WHERE len(ws) > 0),
        n AS (SELECT id AS item_id, count(*) AS n_shingles FROM s WHERE kind = 'i' GROUP BY id)
        SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, any_value(n_shingles) AS n_shingles
        FROM s d JOIN s i ON d.shingle = i.shingle AND d.kind = 'd' AND i.kind = 'i'
        JOIN n ON n.item_id = i.id
        GROUP BY d.id, i.id HAVING 5 * count(*) >= 4 * any_value(n_shingles)
    """,
    "op6_exact_dedup": """
        WITH d AS (
          SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                          'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
          FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op10_repeated_phrases": r"""
        WITH w AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        p AS MATERIALIZED (
          SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
          FROM w, unnest(range(1, len(ws) - 48)) AS t(i)),
        lead AS MATERIALIZED (SELECT h, min(doc_id) AS first_doc FROM p GROUP BY h),
        gone AS MATERIALIZED (
          SELECT DISTINCT doc_id, i + k AS j
          FROM p JOIN lead USING (h), range(0, 50) AS r(k) WHERE first_doc < doc_id),
        words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
        kept AS (
          SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n
          FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
        SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)
    """,
    "op11_merkle_manifest": r"""
        WITH RECURSIVE
        fields AS (
          SELECT doc_id, lang, text,
                 list_reduce(
                   list_prepend(4294967295, list_transform(
                     string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                   lambda crc, byte: list_reduce(
                     list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                     lambda v, step: xor(v >> 1, (v & 1) * 3988292384))) AS crc,
                 concat(
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
                   coalesce(strlen(source) || ':' || source, '-'),
                   coalesce(strlen(lang) || ':' || lang, '-'),
                   coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head
          FROM documents),
        hashed AS MATERIALIZED (
          SELECT doc_id, coalesce('=' || lang, '') AS tree,
                 sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                 CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || coalesce(
                   strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                          'abcdefghijklmnopqrstuvwxyz'), '-')) END AS other
          FROM fields),
        leaves AS MATERIALIZED (
          SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                 count(*) OVER (PARTITION BY tree) AS n
          FROM hashed),
        lower_nodes AS (
          SELECT tree, 0 AS level, i, n, leaf AS digest FROM leaves
          UNION ALL
          SELECT tree, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY i))
          FROM lower_nodes WHERE n > 1 GROUP BY tree, level, i // 8, n),
        tops AS MATERIALIZED (
          SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n
          FROM lower_nodes WHERE n = 1),
        upper_nodes AS (
          SELECT 0 AS level, i, n, digest FROM tops
          UNION ALL
          SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY i))
          FROM upper_nodes WHERE n > 1 GROUP BY level, i // 8, n),
        nodes AS MATERIALIZED (
          SELECT * FROM lower_nodes UNION ALL SELECT '#', level, i, n, digest FROM upper_nodes),
        beside AS MATERIALIZED (
          SELECT a.tree, a.level, a.i,
                 coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
                 coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
          FROM nodes a LEFT JOIN nodes b
            ON a.tree = b.tree AND a.level = b.level AND a.i // 8 = b.i // 8 AND a.i <> b.i
          GROUP BY a.tree, a.level, a.i),
        walk AS (
          SELECT tree AS own, i AS leaf_i, tree, 0 AS level, i, n, coalesce(other, leaf) AS digest,
                 '' AS proof
          FROM leaves
          UNION ALL
          SELECT w.own, w.leaf_i, CASE WHEN w.n = 1 THEN '#' ELSE w.tree END,
                 CASE WHEN w.n = 1 THEN 0 ELSE w.level + 1 END,
                 CASE WHEN w.n = 1 THEN t.i ELSE w.i // 8 END,
                 CASE WHEN w.n = 1 THEN t.n ELSE (w.n + 7) // 8 END,
                 CASE WHEN w.n = 1 THEN w.digest ELSE sha256(b.l || w.digest || b.r) END,
                 CASE WHEN w.n = 1 THEN w.proof ELSE w.proof || b.l || b.r END
          FROM walk w JOIN beside b ON b.tree = w.tree AND b.level = w.level AND b.i = w.i
          LEFT JOIN tops t ON t.tree = w.tree AND w.n = 1
          WHERE w.tree <> '#' OR w.n > 1)
        SELECT v.doc_id, v.leaf, t.digest AS subroot, u.digest AS root, sha256(w.proof) AS proof_sha256,
               w.digest AS folded_root, w.digest = u.digest AS verified
        FROM leaves v
        JOIN walk w ON w.own = v.tree AND w.leaf_i = v.i AND w.tree = '#' AND w.n = 1
        JOIN tops t ON t.tree = v.tree
        JOIN upper_nodes u ON u.n = 1
    """,
    "op12_filter_audit": r"""
        WITH t AS (
          SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
          FROM documents),
        marks AS (
          SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id),
        flags AS MATERIALIZED (
          SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
                 {'A': len(ws) < 200,
                  'B': 100 * len(list_distinct(ws)) < 50 * len(ws),
                  'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
                  'D': regexp_matches(text, '[#$%&*|]'),
                  'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)} AS f
          FROM t LEFT JOIN marks USING (doc_id)),
        lists AS MATERIALIZED (
          SELECT part, good, bad,
                 CASE WHEN f.A THEN 'A' ELSE '' END || CASE WHEN f.B THEN 'B' ELSE '' END
                 || CASE WHEN f.C THEN 'C' ELSE '' END || CASE WHEN f.D THEN 'D' ELSE '' END
                 || CASE WHEN f.E THEN 'E' ELSE '' END AS fails, count(*) AS n
          FROM flags GROUP BY ALL),
        letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
        orders AS (
          SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
          FROM letter a JOIN letter b ON b.l <> a.l JOIN letter c ON c.l NOT IN (a.l, b.l)
          JOIN letter d ON d.l NOT IN (a.l, b.l, c.l) JOIN letter e ON e.l NOT IN (a.l, b.l, c.l, d.l)),
        steps AS (
          SELECT filter_order, step, filter_order[step] AS l, left(filter_order, step - 1) AS earlier
          FROM orders, range(1, 6) AS r(step)),
        told AS (
          SELECT part, filter_order, step, l, good, bad, n, contains(fails, l) AS here, fails = l AS only_here,
                 length(translate(fails, earlier, '')) < length(fails) AS gone
          FROM steps, lists),
        counted AS (
          SELECT part, filter_order, step, l,
                 coalesce(sum(n) FILTER (NOT here AND NOT gone), 0) AS kept,
                 coalesce(sum(n) FILTER (here AND NOT gone), 0) AS removed,
                 coalesce(sum(n) FILTER (here AND gone), 0) AS redundant,
                 coalesce(sum(n) FILTER (only_here), 0) AS unique_fails,
                 coalesce(sum(n) FILTER (here AND NOT gone AND good), 0) AS good_lost,
                 coalesce(sum(n) FILTER (here AND NOT gone AND bad), 0) AS toxic_lost
          FROM told GROUP BY part, filter_order, step, l)
        SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
               redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
               good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
               (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley
        FROM counted
    """,
}
