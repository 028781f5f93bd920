"""Corpus pipeline: documents through toxicity filtering, near-duplicate removal,
benchmark decontamination, personal-data removal and byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. Between stages ``run`` writes the
rows to the shared folder and reads them back, so a lost executor never
recomputes an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import byte_bpe, decontamination, ngram_join, pii, toxicity
from tidelog.llm.common import broadcast_if_small, stored, table
from tidelog.llm.queries import bpe_files


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from all labelled documents of the stage's input."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    scored = toxicity.score(docs, model, docs.columns, "text")
    return scored.filter(F.col("predicted") == 0).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts, that with the smallest id: five-word shingles, similarity 0.8.

    Texts without words stay; of rows repeated in full one stays. Rows are known by id and text, so an
    id's other texts stay or go by their own groups; of a group, the row with the smallest id and then
    text stays (without any id: the one with the smallest text hash).
    """
    found = ngram_join.similar(docs, width=5, percent=80, with_text_hash=True).filter("n_shingles > 0")
    at = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("-"), F.col("text_hash").cast("string")))
    rows = stored(found.select("doc_id", "text_hash", group.alias("group")).groupBy("doc_id", "text_hash", "group")
                  .agg(F.count(F.lit(1)).alias("copies")), "grouped_rows")
    first = rows.groupBy("group").agg(F.min(at).alias("first"))
    gone = stored(rows.join(first, "group").filter(at != F.col("first")).select("doc_id", "text_hash"), "gone")
    keyed = docs.withColumn("__text_hash", F.xxhash64(F.col("text").cast("string")))

    gone, twice = (broadcast_if_small(t, F.lit(24)) for t in (gone, stored(rows.filter("copies > 1").select("doc_id", "text_hash"), "twice")))
    left = keyed.join(gone.withColumnsRenamed({"doc_id": "__id"}), F.col("doc_id").eqNullSafe(F.col("__id"))
                      & (F.col("__text_hash") == F.col("text_hash")), "left_anti")
    if not twice.limit(1).count():
        return left.select(*docs.columns)
    match = twice.withColumnsRenamed({"doc_id": "__id"})
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("text_hash"))
    return left.join(match, same, "left_anti").select(*docs.columns) \
        .unionByName(left.join(match, same, "left_semi").select(*docs.columns).dropDuplicates())


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontamination.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("hit") == 0).select(*docs.columns)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data generalised or removed; ``n_chars`` follows the text."""
    clean = pii.sanitise(pii.find(docs, docs.columns))
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian uint32) and whether decoding gave the text back."""
    coded = byte_bpe.encode_decode(docs, *bpe_files(), keep=["doc_id", "lang", "source", "text"])
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", remove_personal_data),
    ("byte_bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
