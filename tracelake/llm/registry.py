"""The queries ``opN_*`` and ``pipeline``, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out

Query = Callable[[SparkSession, str], DataFrame]


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _learnt(labels: DataFrame, label: str) -> DataFrame:
    """doc_id, label of the labelled rows outside the held-out fifth."""
    return labels.where(~held_out("doc_id", 5, 0)).select("doc_id", F.col(label).alias("label"))


def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import token_file

    return token_file.digest(token_file.token_file(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"), end_id=2))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, _learnt(labels, "toxic"))
    scored = toxicity.predict(docs, model)
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"), F.col("_vote").alias("vote"), F.col("_evidence").alias("evidence"))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import media

    return media.media_column(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality_cnn

    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    net = quality_cnn.fit(docs, _learnt(labels, "quality"))
    return quality_cnn.predict(docs, net).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import line_dedup

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeats(docs).select("doc_id", "text", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import order_minhash

    return order_minhash.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "chosen")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontamination

    return decontamination.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import token_counts

    return token_counts.token_counts(_table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing

    return mixing.mix(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import language_id

    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~held_out("doc_id", 4, 2)))
    return language_id.predict(docs, model).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import periodic_runs

    return periodic_runs.digest(_table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import divergence

    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import context_tree

    out = context_tree.score(_table(spark, sf_dir, "documents").select("doc_id", "text"), ~held_out("doc_id", 10, 0))
    return out.select(
        "doc_id", held_out("doc_id", 10, 0).alias("held_out"), F.col("_n_tokens").alias("n_tokens"), F.col("_n_known").alias("n_known"), F.col("_train_tokens").alias("train_tokens"),
        F.col("_base").alias("base_score"), F.col("_log10").alias("score"), F.col("_bits_per_byte").alias("bits_per_byte"),
    )


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from . import oracles

    return dict(oracles.SQL)
