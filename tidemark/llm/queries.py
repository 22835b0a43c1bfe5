"""The registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import balltree, bpe, centroids, jaccard, lm, mixing, neighbours, phrases, quality, repeats, secrets, toxicity, urls
from .common import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(urls.CONTRACT_RULES, urls.RULES)
    return urls.judge(table(spark, sf_dir, "pages"), rules)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("byte_bpe_50k.tiktoken"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centres = centroids.cluster(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    total = F.sum("inertia").over(Window.partitionBy(F.lit(0))).cast("long").alias("inertia")
    told = centres.select("cluster", F.col("inertia").cast("long").alias("cluster_inertia"), total, digest.alias("centroid_sha256"))
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return found.join(F.broadcast(told), "cluster", "left").select(*columns)  # 16 rows


def op12_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_products(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: f for k, f in globals().items() if k.startswith("op") and k[2:3].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": urls.ORACLE, "op3_substring_dedup": repeats.ORACLE, "op5_mixing": mixing.oracle(), "op11_centroids": centroids.oracle(), "op12_top_products": balltree.oracle(), "op13_collocations": phrases.ORACLE}
