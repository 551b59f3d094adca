"""The numbered operators as queries over the given tables, with their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from eventlift.llm.decontaminate import benchmark_hits
from eventlift.llm.jaccard import jaccard_components
from eventlift.llm.langid import predict_language
from eventlift.llm.lexical import RANKED_SQL, ranked
from eventlift.llm.mixing import domains, mixed
from eventlift.llm.passages import repeated_passages
from eventlift.llm.quotes import reply_ordered
from eventlift.llm.ship import ship
from eventlift.llm.sketch import fingerprints
from eventlift.llm.suffix_tree import scores
from eventlift.llm.tables import table
from eventlift.llm.template import main_texts
from eventlift.llm.token_files import token_index
from eventlift.llm.variants import GROUPS_SQL, spelling_groups
from eventlift.llm.warc import archived


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index(table(spark, sf_dir, "documents"), byte_bpe())


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op3_reply_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(table(spark, sf_dir, "conversations"))


def held_out():
    """Documents that language models are tested on: crc32 of the doc_id's digits divisible by 5."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labelled = docs.where(~held_out()).select(F.col("doc_id").alias("key"), "lang", "text")
    found = predict_language(docs.select("doc_id", "text"), labelled)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op6_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


#: Shares of the mix by domain; what is toxic goes.
MIX = {"clean": 0.9, "poor": 0.1, "toxic": 0.0}


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixed(table(spark, sf_dir, "documents").select("doc_id", "text"), domains(table(spark, sf_dir, "labels")), MIX)
    return found.select("doc_id", F.col("mix_tokens").alias("n_tokens"), F.col("mix_posteriors").alias("posteriors"), F.col("rows").alias("n_rows"), F.col("mix_rate").alias("rate"), F.col("mix_targets").alias("targets"), F.col("mix_attained").alias("attained"))


def op11_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))


_QUERIES = [op1_token_files, op2_jaccard_join, op3_reply_order, op4_language_id, op5_main_text, op6_benchmark_hits, op7_repeated_passages, op8_fingerprints, op9_warc, op10_mixing, op11_suffix_tree, op12_ranked_search, op13_spelling_groups]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(spark, sf_dir)

        return run

    return {build.__name__: shipped(build) for build in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op12_ranked_search": RANKED_SQL, "op13_spelling_groups": GROUPS_SQL}
