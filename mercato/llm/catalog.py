"""Registered queries of this subpackage (see each operator's module)."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.llm import ctw
from mercato.llm import decontamination as dc
from mercato.llm import langid as lid
from mercato.llm import minhash, packing, pii, pipeline, repair
from mercato.llm import simhash as sh
from mercato.llm import tokencount, turns, urlfilter, variants, warc
from mercato.llm.common import crc32_of_id, read

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return deco


def queries() -> dict:
    return {**QUERIES, "pipeline": pipeline.run}


def oracle_sql() -> dict:
    return {**ORACLE, **({"pipeline": pipeline.ORACLE_SQL} if pipeline.ORACLE_SQL else {})}


@query("op1_repair_token_file")
def op1(spark, sf_dir):
    return repair.token_file(read(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False)


@query("op5_wu_manber_decontamination")
def op5(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = dc.decontaminate(docs, read(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        dc.items_digest(F.col("items")).alias("items_sha256"), "contaminated")


@query("op8_simhash_trie_join")
def op8(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = sh.near_duplicates(docs, keep=["doc_id"])
    return found.select("doc_id", sh.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


@query("op2_one_permutation_minhash")
def op2(spark, sf_dir):
    return minhash.with_next(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op3_context_tree_weighting")
def op3(spark, sf_dir):
    return ctw.score(read(spark, sf_dir, "documents").select("doc_id", "text"), ctw.held_out_rule(F.col("doc_id")))


@query("op4_script_viterbi_langid")
def op4(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc32_of_id(F.col("doc_id")) % 5 == 0
    model = lid.fit(docs.where(~held_out))
    return (lid.identify(docs, model, keep=["doc_id"])
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "spans"))


@query("op6_feistel_pseudonyms")
def op6(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs).select("doc_id", "text", "n_values")


@query("op7_linear_grouping_packing")
def op7(spark, sf_dir):
    placed = packing.pack(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op9_pretoken_counts")
def op9(spark, sf_dir):
    return tokencount.count_tokens(read(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])


URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]

URL_SQL = r"""
WITH r(verdict, host, path) AS (VALUES """ + ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES) + r"""),
p AS (SELECT page_id, row_number() OVER () AS rid,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
j AS (SELECT p.*, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY rid ORDER BY length(r.host || r.path) DESC, r.verdict DESC) AS k
      FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM j WHERE k = 1
"""


@query("op10_url_range_join", URL_SQL)
def op10(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, urlfilter.rule_table(spark, URL_RULES)).drop("url")


WARC_SQL = r"""
WITH d AS (SELECT page_id, coalesce(html, '') AS html, row_number() OVER () AS rid FROM pages),
x AS (SELECT page_id, rid, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex,
             row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, rid) AS k,
             max(page_id) OVER (PARTITION BY html) AS top FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + (((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT)) >> CAST(15 - 5 * (i % 4) AS INT)) & 31), 1)), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k = 1 THEN NULL ELSE top END AS refers_to
FROM x
"""


@query("op11_warc_normaliser", WARC_SQL)
def op11(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = warc.read_archives(warc.archive(pages), pages.schema["page_id"].dataType, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op13_conversation_repair")
def op13(spark, sf_dir):
    return turns.with_digest(turns.repair(turns.damage(read(spark, sf_dir, "conversations"))))


VARIANTS_SQL = r"""
WITH RECURSIVE crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT))) AS tab),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc, run, count(*) AS m, hex(encode(doc || ':' || run)) AS hex FROM runs GROUP BY doc, run),
hashed AS (SELECT run, m, xor(4294967295, list_reduce(
        list_transform(range(length(hex) // 2), lambda i: CAST('0x' || substr(hex, 2 * i + 1, 2) AS BIGINT)),
        lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1]), 4294967295)) AS h FROM counted, crc_table),
spelled AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
        ELSE run END AS word, m FROM hashed),
words AS (SELECT word, CAST(sum(m) AS BIGINT) AS n FROM spelled WHERE length(word) >= 5 GROUP BY word HAVING sum(m) >= 3),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
links AS (SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
        UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
        UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY m DESC, encode(other)) AS k,
        count(*) OVER (PARTITION BY word) AS n_near FROM links),
forms AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.m >= 2 * w.n THEN r.other END AS form,
        CASE WHEN r.m >= 2 * w.n THEN r.m END AS form_n FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1),
chain AS (SELECT word, word AS at, form AS next FROM forms
        UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""


@query("op12_gram_index_variants", VARIANTS_SQL)
def op12(spark, sf_dir):
    return variants.variants(variants.word_counts(read(spark, sf_dir, "documents").select("doc_id", "text")))
