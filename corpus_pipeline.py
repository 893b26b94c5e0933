"""A corpus pipeline of five stages, each applying one operator of ``kinesia.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
its result is written as Parquet and read again as the next stage's ``docs``. All
stages but the last return the columns of ``documents``. Stages are defined for null
texts and ids, empty tables and further columns: see each function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinesia.llm import bpe, exact_dedup, langid, mixing, ngram_join
from kinesia.llm.graph import stored
from kinesia.llm.queries import tokenizer_path

WORDS, PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a language; null texts and texts without a letter go."""
    prototypes = langid.fit_prototypes(spark, docs.filter(~langid.held_out("doc_id")), "text", "lang")
    predicted = langid.language_udf(prototypes)(F.col("text"))
    return docs.filter(predicted["lang_pred"] != langid.UNKNOWN)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space, the row with the smallest doc_id."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group linked by shingle similarity, and rows without a doc_id."""
    groups = ngram_join.similar_sets(spark, docs, words=WORDS, percent=PERCENT)
    gone = groups.filter("doc_id != component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times (0, 1, 2) as the mix takes its words, to the nearest whole time."""
    mix = mixing.mix_sources(docs).groupBy("doc_id", "size").agg(F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("n"))
    times = F.round(F.col("taken") / (F.col("size") * F.col("n"))).cast("int")
    taken = mix.filter("size > 0").select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), times.alias("_times")).filter("_times > 0")
    same = docs["doc_id"].eqNullSafe(taken["_id"]) & (mixing.count_words(docs["text"]) == taken["_size"])
    rows = docs.join(taken, same).select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), F.explode(F.sequence(F.lit(1), taken["_times"])))
    return rows.select("_row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    return bpe.encode_digests(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mix", mix_to_weights),
    ("bpe", encode),
]

# Language ID cannot be said in SQL; tests hold the pipeline against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
