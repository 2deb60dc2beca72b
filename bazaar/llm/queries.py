"""The numbered operators as queries over the given tables, and SQL counterparts."""

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.llm import chat, jaccard, language, lines, merkle, mixing, packing, pii, quality, secret_scan, toxicity, vectors, whitening
from bazaar.session import settle

ROWS_PER_BATCH = "1000"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def ready(spark: SparkSession) -> SparkSession:
    """Settings, and Python workers that find this package where they see the same folder as the driver."""
    environment, home = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if home not in (path := environment.get("PYTHONPATH", "")).split(":"):
        environment["PYTHONPATH"] = f"{home}:{path}".rstrip(":")
    # Texts are long: fewer of them at a time between the JVM and Python keep both small.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return settle(spark)


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(ready(spark), sf_dir)
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), packing.vocabulary())


@query
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"))


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every finding with its score; the candidate itself as a fingerprint."""
    rows = secret_scan.scan(table(spark, sf_dir, "documents"))
    return rows.withColumn("fingerprint", F.sha2("candidate", 256)).drop("candidate")


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"))


@query
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(table(spark, sf_dir, "conversations"))


@query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.linked(table(spark, sf_dir, "embeddings"))


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its remaining text; emptied ones too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.deduplicated(docs, keep_empty=True).withColumn("n_lines", F.size(F.split("text", "\n")))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of all documents, and which of them verify after some were changed."""
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.tampered())


@query
def op12_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
