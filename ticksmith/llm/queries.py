"""Registered queries of the dealt operators, with production parameters.

``QUERIES`` maps a name to a (spark, sf_dir) callable over whole tables.
``ORACLE`` has the DuckDB SQL of those that SQL can express at test size.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.llm import (ann, bit_sliced, bpe, chosen_path, conversations, decontaminate, html_extract, jaccard, licenses, quality, substring_dedup,
                           url_reputation, warc)
from ticksmith.plans.storage import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op1_host_reputation(spark, sf_dir):
    """A page's outcome is the label of the document that its url's number names."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(url_reputation.path_of(F.col("url")), "/([0-9]{1,18})", 1)
    numbered = pages.select("url", F.when(number != "", number).cast("bigint").alias("doc_id"))
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("bad"))
    return url_reputation.judge(pages, numbered.join(labels, "doc_id").select("url", "bad"), RULES)


def op2_chunked_records(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.records(warc.read_chunks(spark, path))


def op3_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select(F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"), "text", "n_chars")


def op4_winnowing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_hnsw(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, F.col("vec_id") % 50 == 0)


def op6_super_kmers(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup_substrings(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def train_quality(spark, sf_dir, docs):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality.train(docs, labels.where(quality.remainder(F.col("doc_id")) != 0))


def op7_line_crf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_quality(spark, sf_dir, docs)
    doc_id = F.col("row.doc_id")
    return quality.score(docs, model).select(
        doc_id.alias("doc_id"), F.coalesce(quality.remainder(doc_id) == 0, F.lit(False)).alias("held_out"),
        "score", "predicted")


def op8_conditional_compression(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_blocks", "licenses", "n_exact", "best_reduction")


def op9_signature_trees(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                      k=3, threshold=Fraction(90, 100))


def op10_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_documents(docs, vocabulary_path()).select(
        F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


def op11_chosen_path(spark, sf_dir):
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), k=5, threshold=Fraction(85, 100))


def op12_structure_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.repair(conversations.damage(rows))


def op13_bit_sliced(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bit_sliced.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


QUERIES = {f.__name__: f for f in (op1_host_reputation, op2_chunked_records, op3_main_text, op4_winnowing, op5_hnsw, op6_super_kmers,
                                  op7_line_crf, op8_conditional_compression, op9_signature_trees, op10_byte_bpe, op11_chosen_path,
                                  op12_structure_repair, op13_bit_sliced)}

def _components_sql(k: int, num: int, den: int, kept: str = "") -> str:
    """Components of all pairs of distinct shingle sets, which SQL can list at test size only."""
    return rf"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
         ELSE list_sort(list_distinct(list_transform(range(1, len(w) - {k - 1} + 1), lambda p: array_to_string(list_slice(w, p, p + {k - 1}), ' ')))) END AS s FROM words),
classes AS (SELECT min(doc_id) AS id, len(s) AS n, s FROM sets WHERE len(s) > 0 GROUP BY s),
grams AS (SELECT id, n, unnest(s) AS g FROM classes),
links AS (SELECT a.id AS a, b.id AS b FROM grams AS a JOIN grams AS b ON a.g = b.g AND a.id <> b.id AND {den} * least(a.n, b.n) >= {num} * greatest(a.n, b.n)
          GROUP BY a.id, b.id, a.n, b.n HAVING {den} * count(*) >= {num} * (a.n + b.n - count(*))),
reach(id, other) AS (SELECT id, id FROM classes UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a),
low AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id{kept}
FROM sets LEFT JOIN classes ON sets.s = classes.s LEFT JOIN low USING (id)"""


ORACLE = {
    "op2_chunked_records": """
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN strlen(h) >= 100 AND page_id <> min(page_id) OVER (PARTITION BY h) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(h) >= 100 AND page_id <> min(page_id) OVER (PARTITION BY h) THEN min(page_id) OVER (PARTITION BY h) END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS h FROM pages)""",
    "op9_signature_trees": _components_sql(3, 90, 100),
    "op11_chosen_path": _components_sql(5, 85, 100, ", coalesce(component_id, doc_id) = doc_id AS kept"),
    "op4_winnowing": r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, p, p + least(10, len(w)) - 1), ' ') AS g
          FROM item_words, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(p) WHERE len(w) > 0),
hits AS (SELECT d.doc_id, d.p, d.n, grams.item_id
         FROM (SELECT doc_id, p, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS g
               FROM words, (SELECT DISTINCT n FROM grams) AS sizes, unnest(range(1, len(w) - n + 2)) AS t(p)) AS d
         JOIN grams USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hits, unnest(range(p, p + n)) AS t(q) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op6_super_kmers": r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, p, array_to_string(list_slice(w, p, p + 34), ' ') AS g FROM words, unnest(range(1, len(w) - 33)) AS t(p)),
again AS (SELECT doc_id, p FROM starts JOIN (SELECT g FROM starts GROUP BY g HAVING count(*) > 1) USING (g)),
gone AS (SELECT DISTINCT doc_id, q FROM again, unnest(range(p, p + 35)) AS t(q)),
each AS (SELECT doc_id, q, w[q] AS word FROM words, unnest(range(1, len(w) + 1)) AS t(q)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS text FROM each ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)""",
    "op13_bit_sliced": r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
size AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM words WHERE len(w) > 0),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM words) GROUP BY doc_id, n, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, size GROUP BY term, docs),
scores AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
           FROM asked JOIN tf USING (term) JOIN weights USING (term), size GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20""",
}
