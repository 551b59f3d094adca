"""A corpus pipeline: language, near duplicates, benchmark passages, mix, token files.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; its result is
written as a table and read again.  All but the last return the columns of ``documents``.
Rows without doc_id stay in the stages that decide by doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlift.llm.decontaminate import benchmark_hits
from eventlift.llm.jaccard import jaccard_components
from eventlift.llm.langid import UNDETERMINED, predict_language
from eventlift.llm.mixing import domains, mixed
from eventlift.llm.queries import MIX, byte_bpe, held_out
from eventlift.llm.ship import ship
from eventlift.llm.tables import table, written
from eventlift.llm.token_files import token_index


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: without a letter, or without any evidence."""
    ship(spark)
    labelled = docs.where(~held_out()).select(F.col("doc_id").alias("key"), "lang", "text")
    others = [F.col(c) for c in docs.columns if c != "text"]
    found = predict_language(docs.select(F.struct(*others).alias("others"), "text"), labelled)
    kept = found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") > 0))
    return kept.select(*[F.col(c) if c == "text" else F.col(f"others.{c}") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each group of linked documents, once."""
    ship(spark)
    kept = jaccard_components(docs).where("doc_id = component_id").select("doc_id").distinct()
    once = docs.where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return once.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    ship(spark)
    hits = written(benchmark_hits(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "pipeline-hits")
    return docs.join(hits, "doc_id", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps each document with its mixing rate as probability, drawn by a hash; rates are solved for within 0 to 1."""
    ship(spark)
    found = mixed(docs.select("doc_id", "text"), domains(table(spark, sf_dir, "labels")), MIX, most=1.0)
    draw = F.pmod(F.xxhash64("doc_id", "mix_hash", F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    kept = found.where(draw < F.col("mix_rate")).select(F.col("doc_id").alias("kept_id"), "mix_hash")
    keyed = docs.withColumn("mix_own_hash", F.xxhash64("text"))
    match = keyed["doc_id"].eqNullSafe(kept["kept_id"]) & (keyed["mix_own_hash"] == kept["mix_hash"])
    return keyed.join(kept, match, "left_semi").select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, in files; returns their index."""
    ship(spark)
    return token_index(docs, byte_bpe())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark", decontaminated),
    ("mixing", mix),
    ("token_files", token_files),
]

#: Suffix automata, fingerprints and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
