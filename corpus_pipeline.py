"""A corpus from raw documents to token ids, in stages that each write what they keep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, mixing, pieces, quality, secret_scan
from tidemark.llm.registry import MIXTURE, PIECES_MODEL, send_package
from tidemark.session import FREE_SHUFFLES, new_workdir, settings

REJECTED_BELOW = 0.7
MASK = "[SECRET]"
# Rows whose texts are masked together.
TOGETHER = 256
# Near duplicates: a Jaccard similarity of 0.8 or more over distinct shingles of five words.
NEAR = jaccard.Rule(shingle=5, part=80, whole=100)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose score is not below the threshold; those without text or id are scored like any other."""
    send_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(f"NOT ({quality.HELD_OUT})")
    model = quality.fit(docs, labels)
    sent = spark.sparkContext.broadcast(model)
    schema, columns = docs.schema, docs.columns

    def good(batches):
        for b in batches:
            texts = (t.as_py() for t in b.column(columns.index("text")))
            keep = []
            for _, held in quality.chunks(range(b.num_rows), texts, quality.CHUNK_BYTES):
                keep += [bool(s >= REJECTED_BELOW) for s in sent.value.scores(held)]
            yield b.filter(quality.pa.array(keep, quality.pa.bool_()))

    return docs.mapInArrow(good, schema)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links connect, the one of smallest id; documents without an id stay.

    Of rows that share an id one stays: one with a text if there is any, then the smallest by its columns, in their order.
    """
    send_package(spark)
    # Written, so that its size is known: where no id is repeated, it is broadcast and no row travels for it.
    path = new_workdir(spark, "repeated")
    with settings(spark, FREE_SHUFFLES):
        docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id").write.parquet(path)
    repeated = spark.read.schema(docs.select("doc_id").schema).parquet(path)
    least = F.min(F.struct(F.col("text").isNull().alias("empty"), F.struct(*docs.columns).alias("row"))).alias("least")
    chosen = docs.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(least).select("least.row.*")
    single = docs.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(chosen)
    kept = jaccard.linked(docs, NEAR).where("component_id = doc_id").select("doc_id").distinct()
    return single.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mask; overlapping spans are masked as one, and ``n_chars`` follows the text."""
    send_package(spark)
    schema, columns = docs.schema, docs.columns
    at, size = columns.index("text"), columns.index("n_chars")
    pa = secret_scan.pa

    def masked(text: str | None) -> str | None:
        if not text:
            return text
        out, end, shown = [], 0, False
        for s in secret_scan.spans(text):
            if s["start"] > end or not shown:
                out += [text[end:s["start"]], MASK]
            shown, end = True, max(end, s["end"])
        return "".join(out) + text[end:] if shown else text

    def scan(batches):
        for b in (whole.slice(k, TOGETHER) for whole in batches for k in range(0, whole.num_rows, TOGETHER)):
            old = b.column(at).to_pylist()
            new = [masked(t) for t in old]
            sizes = [n if a == t else len(t) for n, a, t in zip(b.column(size).to_pylist(), old, new)]
            arrays = list(b.columns)
            arrays[at], arrays[size] = pa.array(new, b.schema.field(at).type), pa.array(sizes, b.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=b.schema)

    return docs.mapInArrow(scan, schema)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as its rate calls for, so that the languages' tokens meet the mixture."""
    send_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id").distinct()
    domains = mixing.fit_domains(docs, docs.select("doc_id", "lang").join(labels, "doc_id"), sorted(MIXTURE))
    # Rows are told apart by id and text: equal rows have equal rates.
    counts = mixing.mix_to_targets(docs, domains, MIXTURE).groupBy("code").agg(F.min("copies").alias("copies")).where("copies > 0")
    # Rows travel as one value, so that no name of theirs can meet one used here.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("doc_id", "text").alias("code")).join(counts, "code")
    return rows.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document."""
    send_package(spark)
    return pieces.encode(docs, pieces.vocabulary(PIECES_MODEL)).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("mixture", mixture),
    ("piece_ids", piece_ids),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each reads what the one before has written."""
    docs, work = spark.read.parquet(f"{sf_dir}/documents.parquet"), new_workdir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return result
        with settings(spark, FREE_SHUFFLES):
            result.write.parquet(f"{work}/{k}-{name}")
        docs = spark.read.schema(result.schema).parquet(f"{work}/{k}-{name}")
    return docs
