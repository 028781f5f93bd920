"""Registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import (byte_bpe, conversation_repair, decontamination, html_extraction, lexical_search, minhash,
                         ngram_join, pii, quality_rules, quality_trees, sharding, token_rollup, toxicity)
from tidelog.llm.common import id_bucket, table, work_dir


def _with_held_out(df: DataFrame, modulus: int, remainder: int) -> DataFrame:
    return df.withColumn("held_out", F.coalesce(id_bucket(F.col("doc_id"), modulus) == remainder, F.lit(False)))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, id_bucket(F.col("doc_id"), 5) != 0)
    return _with_held_out(toxicity.score(docs, model, ["doc_id"]), 5, 0)


def bpe_files() -> tuple[str, str]:
    """Path of the rank file and the pre-token pattern (a public package on the driver)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.encode_decode(table(spark, sf_dir, "documents"), *bpe_files(), keep=["doc_id"])
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", F.size("hit").cast("bigint").alias("n_hit"),
                        F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.size("hit") > 0).alias("contaminated"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), n_shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), ["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    base, terms = pii.as_text(F.col("base")), pii.as_text(F.col("terms"), F.lit("term"))
    both = F.array_join(F.filter(F.array(base, terms), lambda s: s != ""), ",")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(base.cast("binary"), 256).alias("base_sha256"), both.alias("spans"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"), width=3, percent=90)


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.main_text(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    forest = quality_trees.train(docs, labels, id_bucket(F.col("doc_id"), 3) != 1)
    return _with_held_out(quality_trees.score(docs, forest, ["doc_id"]), 3, 1)


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), ["doc_id"])


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in; every seventh is revised (a line is added, counted anew by both
    tokenizers); every eleventh goes; each batch is committed twice."""
    docs = table(spark, sf_dir, "documents")
    names = list(token_rollup.TOKENIZERS)
    revised = docs.filter(F.col("doc_id") % 7 == 0)
    later = revised.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit("\nRevised edition, 2nd.")))
    now = docs.filter(~F.coalesce(F.col("doc_id") % 7 == 0, F.lit(False))).unionByName(later)
    count = lambda df: token_rollup.count_tokens(df, names)
    root = work_dir(spark, "token_rollup")
    batches = [("1-load", token_rollup.inserts(count(docs))),
               ("2-revise", token_rollup.revisions(count(revised), count(later))),
               ("3-delete", token_rollup.deletes(count(now.filter(F.col("doc_id") % 11 == 0))))]
    for _ in range(2):
        for batch_id, changes in batches:
            token_rollup.commit(changes, root, batch_id)
    return token_rollup.totals(spark, root)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.report(conversations, conversation_repair.damage(conversations))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_byte_bpe, op3_decontamination, op4_shards, op5_pii, op6_ngram_join,
                            op7_main_text, op8_quality, op9_rules, op10_token_counts, op11_lexical_search,
                            op12_conversation_repair, op13_minhash)
}

# Words of op3, terms of op11, and the two tokenizers of op10, as DuckDB expressions of ``text``.
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
         r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
         r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACE = r"len(regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+'))"
_ALNUM = r"len(regexp_extract_all(coalesce({}, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"

ORACLE: dict[str, str] = {
    "op3_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
i AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS t
        FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM i)),
seen AS (SELECT r, k, s, array_to_string(w[s:s + k - 1], ' ') AS t
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM win))),
hit AS (SELECT r, s, seen.k AS k, item_id FROM seen JOIN win ON seen.t = win.t AND seen.k = win.k),
pos AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + k)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, pos.n IS NOT NULL AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN items USING (r)""",
    "op11_lexical_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
one AS (SELECT count(*) AS nd, sum(len(w)) AS nt FROM d WHERE len(w) > 0),
i AS (SELECT row_number() OVER () AS q, item_id, list_distinct({_TERMS}) AS w FROM benchmark),
want AS (SELECT q, item_id, unnest(w) AS t FROM i),
have AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM want) GROUP BY r, t),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
           FROM have, one GROUP BY t, nd),
value AS (SELECT r, t, (1000000000 * tf) // (1000 * tf + 8 * CAST(10 + (90 * len(d.w) * nd) // nt AS BIGINT)) AS v
          FROM have JOIN d USING (r), one),
scored AS (SELECT q, item_id, doc_id, r, CAST(sum(weight.w * v) AS BIGINT) AS score
           FROM want JOIN weight USING (t) JOIN value USING (t) JOIN d USING (r) GROUP BY q, item_id, doc_id, r),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
           FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op10_token_counts": f"""
WITH d AS (SELECT doc_id, source, lang, CASE WHEN doc_id % 7 = 0
             THEN coalesce(text, '') || chr(10) || 'Revised edition, 2nd.' ELSE text END AS text FROM documents),
k AS (SELECT * FROM d WHERE doc_id IS NULL OR doc_id % 11 <> 0),
c AS (SELECT source, lang, 'space-1' AS tokenizer, {_SPACE.format("text")} AS n FROM k
      UNION ALL SELECT source, lang, 'alnum-1', {_ALNUM.format("text")} FROM k)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM c GROUP BY source, lang, tokenizer""",
}
