"""Token counts kept up to date by signed deltas.

A rollup is a folder of committed batches. A batch is a table of changes to
documents, each one an insert, a delete or a revised count; it becomes signed
sums per (source, lang, tokenizer): an insert adds (1 document, n tokens), a
delete takes its old count away, a revision adds the difference. Totals are the
sums over all committed batches, so they are additive and never recounted.

Commits are idempotent: a batch is written below its own id and becomes visible
by its ``_SUCCESS`` mark; committing the same id again leaves it as it is, and a
batch cut off half-way is overwritten by the retry. ``compact`` folds committed
batches into one, under the ids it stands for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["n_docs", "n_tokens"]
SCHEMA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


def white_space_words(text: Column) -> Column:
    """Tokenizer ``space-1``: runs of characters other than ASCII white space."""
    return _runs(text, r"[\x20\x09-\x0D]+")


def alphanumeric_words(text: Column) -> Column:
    """Tokenizer ``alnum-1``: runs of ASCII letters, digits and characters beyond ASCII."""
    return _runs(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _runs(text: Column, gap: str) -> Column:
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), gap)
    blank = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) \
        + F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return (F.size(parts) - blank).cast("bigint")


TOKENIZERS = {"space-1": white_space_words, "alnum-1": alphanumeric_words}


def count_tokens(docs: DataFrame, tokenizers: list[str], source_col: str = "source", lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """One row per document and tokenizer: source, lang, tokenizer, n_tokens.

    Null and empty texts count 0 tokens; a null source or lang stays null (a
    key of its own); repeated rows count each; extra columns are not read.
    """
    counts = F.array(*[F.struct(F.lit(t).alias("tokenizer"), TOKENIZERS[t](F.col(text_col)).alias("n_tokens"))
                       for t in tokenizers])
    return docs.select(F.col(source_col).cast("string").alias("source"),
                       F.col(lang_col).cast("string").alias("lang"), F.inline(counts))


def inserts(counted: DataFrame) -> DataFrame:
    """Changes of new documents."""
    return counted.select(*KEYS, F.lit(1).cast("bigint").alias("n_docs"), "n_tokens")


def deletes(counted: DataFrame) -> DataFrame:
    """Changes of documents that go, with the counts they had."""
    return counted.select(*KEYS, F.lit(-1).cast("bigint").alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes of documents whose text, source or tokenizer version is another now."""
    return deletes(old).unionByName(inserts(new))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def is_committed(spark: SparkSession, root: str, batch_id: str) -> bool:
    fs, p = _fs(spark, f"{root}/batch={batch_id}/_SUCCESS")
    return fs.exists(p)


def commit(changes: DataFrame, root: str, batch_id: str) -> bool:
    """Add a batch of changes under its id; False (and no work) where that id is committed.

    Changes are summed before the shuffle, so a source that holds most rows
    sends one row per task; keys whose sums are all 0 are kept, they do no harm.
    """
    spark = changes.sparkSession
    if is_committed(spark, root, batch_id):
        return False
    changes.groupBy(*KEYS).agg(*[F.sum(c).cast("bigint").alias(c) for c in SUMS]) \
        .write.mode("overwrite").parquet(f"{root}/batch={batch_id}")
    return True


def committed(spark: SparkSession, root: str) -> list[str]:
    """Ids of the committed batches, in order of their names."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    ids = sorted(n.removeprefix("batch=") for n in names if n.startswith("batch="))
    return [i for i in ids if is_committed(spark, root, i)]


def totals(spark: SparkSession, root: str, batches: list[str] | None = None) -> DataFrame:
    """source, lang, tokenizer, n_docs, n_tokens over all committed batches (or the given
    ones of them); keys without documents and tokens are left out. No batch: an empty result."""
    paths = [f"{root}/batch={i}" for i in (committed(spark, root) if batches is None else batches)]
    rows = spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)
    return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]) \
        .filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))


def compact(spark: SparkSession, root: str, new_root: str) -> list[str]:
    """Write the totals as the one base batch of ``new_root``; the ids folded in (returned)
    become empty batches there, so committing one of them again does nothing.

    The batches are listed once, and the list is stored before anything else: a batch
    committed meanwhile is neither summed nor marked (it can still be committed to
    ``new_root``), and a compaction begun anew after a loss folds the same batches.
    """
    fs, done = _fs(spark, f"{new_root}/_folded/_SUCCESS")
    if not fs.exists(done):
        spark.createDataFrame([(i,) for i in committed(spark, root)], "id string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{new_root}/_folded")
    folded = sorted(r.id for r in spark.read.schema("id string").parquet(f"{new_root}/_folded").collect())
    base = totals(spark, root, folded)
    commit(base, new_root, "0-base")
    for i in folded:
        commit(base.limit(0), new_root, i)
    return folded
