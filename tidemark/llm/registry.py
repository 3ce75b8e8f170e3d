"""The registered queries: each operator over its whole table, and SQL where it can express one."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, audit, decontaminate, jaccard, lexical, licences, mixing, pieces, pii, quality, repeats, secret_scan, topk

PIECES_MODEL = os.environ.get("TIDEMARK_PIECES_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
# Shares of the tokens that the mixture is to have, by language.
MIXTURE = {"en": 0.5, "de": 0.2, "fr": 0.15, "es": 0.15}

_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Hands this package to the executors, once for each application, for sessions in which it is not installed there."""
    app = spark.sparkContext.applicationId
    if app not in _sent:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        folder = tempfile.mkdtemp(prefix="tidemark-package-")
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/tidemark", "zip", root, "tidemark"))
        _sent.add(app)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    send_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(_table(spark, sf_dir, "documents")))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(_table(spark, sf_dir, "documents"))


def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    labelled = labels.select("doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    domains = mixing.fit_domains(docs, labelled, sorted(MIXTURE))
    return mixing.mix_to_targets(docs, domains, MIXTURE).drop("code")


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.where("vec_id % 20 = 0"), 20)


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, words = _table(spark, sf_dir, "documents"), pieces.vocabulary(PIECES_MODEL)
    # Decoded again: the hash is that of the text itself.
    return pieces.decode(pieces.encode(docs, words), words).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("text", 256).alias("text_sha256"))


def op8_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(_table(spark, sf_dir, "documents")))


def op9_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return topk.top_products(rows, rows.where("vec_id % 50 = 0"), 5)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(_table(spark, sf_dir, "documents")))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.find_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 50)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_quality_classifier, op3_licence_scan, op4_jaccard_join, op5_mixture, op6_nearest_neighbours, op7_pieces,
    op8_repeat_removal, op9_top_products, op10_personal_data, op11_decontamination,
    op12_lexical_search, op13_filter_audit)}

TOP_PRODUCTS_SQL = """
WITH t AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
     s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(d.v AS DOUBLE[])) AS BIGINT) AS score
           FROM t q JOIN t d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""

ORACLES = {"op9_top_products": TOP_PRODUCTS_SQL, "op11_decontamination": decontaminate.DECONTAMINATION_SQL, "op12_lexical_search": lexical.RANKED_SQL,
           "op13_filter_audit": audit.AUDIT_SQL}
