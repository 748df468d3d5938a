"""A corpus made ready for training: five operators over ``documents``, in order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's result as Parquet in the shared folder and reads it back as the next one's
``docs``. All stages but the last return the columns of ``docs``.

Defined results: rows with a null id pass near-dedup and are otherwise treated as any;
rows that repeat an id with one text are one document to near-dedup, those with
texts of several groups are one in each; null and empty texts go at the
language stage, as they have no language; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saasmart.llm import bpe, decontaminate, language_id, secret_scan, simhash
from saasmart.llm.queries import tokenizer
from saasmart.llm.storage import free_name, moderate_batches, scratch, write
from saasmart.session import remove_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(function: Stage) -> Stage:
    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        moderate_batches(spark)
        return function(spark, docs, sf_dir)

    return run


@_stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents that it rejects go."""
    model = language_id.fit(docs)
    found = free_name(docs.columns, "_found")
    return language_id.identify(model, docs, into=found).where(F.col(f"{found}.accepted")).drop(found)


@_stage
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group the document with the smallest id stays."""
    columns = docs.columns
    place, mark = free_name(columns, "_place"), free_name(columns, "_mark")
    firsts = simhash.first_of_each(docs, shingle=4, distance=4).select(F.col("id").alias("doc_id"), F.col("h").alias(mark))
    # repeated rows are one document; the window takes over the join's partitioning
    sortable = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    once = Window.partitionBy("doc_id", mark).orderBy(F.xxhash64(*sortable))
    kept = docs.withColumn(mark, F.xxhash64("text")).join(firsts, ["doc_id", mark], "left_semi") \
        .withColumn(place, F.row_number().over(once)).where(F.col(place) == 1).select(*columns)
    return kept.union(docs.where(F.col("doc_id").isNull()))


@_stage
def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that contain a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_items(docs, items)


@_stage
def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: secrets are replaced in the texts; no document goes."""
    found = free_name(docs.columns, "_found")
    clean = docs.withColumn(found, secret_scan.scan(F.col("text"), keep_text=True))
    new = {"text": F.col(f"{found}.redacted"), "n_chars": F.length(f"{found}.redacted").cast("long")}
    return clean.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: the ids (little-endian unsigned 32-bit) with what decoding them gives."""
    return docs.select("doc_id", "lang", "source", bpe.encode(F.col("text"), *tokenizer(), keep_ids=True).alias("x")) \
        .select("doc_id", "lang", "source", "x.n_tokens", "x.ids", "x.ids_sha256", "x.decoded_sha256")


STAGES = [
    ("language_id", known_language),
    ("simhash", one_of_each),
    ("decontaminate", no_benchmark),
    ("secret_scan", no_secrets),
    ("byte_bpe", tokens),
]

#: SQL can't express the language models, fingerprints and lexers of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.

    A stage's own tables go when its result is written, its result when the next one's is.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        with scratch(spark):
            result = stage(spark, docs, sf_dir)
            path = write(result, name)
        docs = spark.read.schema(result.schema).parquet(path)
        if before is not None:
            remove_folder(spark, before)
        before = path
    return docs
