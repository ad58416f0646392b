"""A corpus pipeline: rated quality, near duplicates, benchmark leaks, secrets, packing.

`STAGES` lists the stages in order. A stage takes all documents its predecessor kept and
returns those it keeps, with the columns of `documents`; the last returns packed pieces.
Nulls in any column pass through: a stage drops a document only for what it found in it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.llm import quality, secrets
from paytide.llm.decontaminate import find_leaks
from paytide.llm.frames import fresh, importable, scratch_path, staged
from paytide.llm.minhash import near_duplicates
from paytide.llm.packing import pack
from paytide.llm.queries import KEEP_FROM, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are unlikely to be of the best grade.

    A text without tokens (null, empty, blank) is judged by the base rates; long texts are
    read whole; equal texts get equal answers. Columns of the classifier's own names pass
    through like all others; an empty table stays empty.
    """
    importable(spark)
    model = quality.fit(quality.graded(docs, table(spark, sf_dir, "labels")))
    names = [f"c{i}" for i in range(len(docs.columns))]
    place = docs.columns.index("text")
    judged = quality.scored(docs.toDF(*names), model, text_col=names[place])
    return judged.filter(F.col("tail_probability") >= KEEP_FROM).select(*names).toDF(*docs.columns)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every group of near duplicates, that of the smallest id; rows are told
    apart by a key of their own, so repeated and missing ids are compared too.

    Texts without words (null, empty, blank) are in no group and stay; of rows tied in their
    id the first stored stays; long texts are read whole; an empty table stays empty.
    """
    importable(spark)
    (key,) = fresh(docs, "row_key")
    keyed = staged(docs.withColumn(key, F.monotonically_increasing_id()))
    found = near_duplicates(keyed, id_col=key).select(
        F.col("doc_id").alias(key),
        # Texts without words are in no group.
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(-1 - F.col("doc_id")).alias("of"),
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", F.col(key).alias("key")))
    kept = found.join(keyed.select(key, "doc_id"), key).groupBy("of").agg(first.alias("first"))
    return keyed.join(kept.select(F.col("first.key").alias(key)), key, "left_semi").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item.

    Documents are told by their texts, so a missing or shared id saves or costs none: all
    rows of a leaking text go, and no other. Null and empty texts stay; long texts are read
    whole; an empty table or benchmark changes nothing.
    """
    importable(spark)
    (key,) = fresh(docs, "text_key")
    keyed = docs.withColumn(key, F.sha2("text", 256))
    leaks = find_leaks(keyed, table(spark, sf_dir, "benchmark"), id_col=key).select(F.col("doc_id").alias(key))
    return keyed.join(leaks.distinct(), key, "left_anti").select(*docs.columns)


def secret_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents; secrets in their texts give way to a mask, and `n_chars`, where
    there is one, follows. Null and empty texts stay as they are; rows are read one by one,
    so ties and repeats do no harm; long texts are read whole; an empty table stays empty."""
    importable(spark)
    model = secrets.fit(secrets.labelled_findings(docs))
    clean = secrets.redact(docs, model)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into windows of 2048 tokens: one row per piece. A null text counts
    as empty; an empty table gives no pieces."""
    importable(spark)
    return pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("near_duplicate_removal", near_duplicate_removal),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_removal", secret_removal),
    ("packing", packing),
]

#: No stage can be written as SQL; tests hold the pipeline against its parts by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each one's rows are written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
