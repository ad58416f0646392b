"""Registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.llm import licenses, quality, secrets, urlfilter
from paytide.llm.alignment import align_tokenizers
from paytide.llm.decontaminate import find_leaks
from paytide.llm.frames import importable, scratch_path
from paytide.llm.minhash import near_duplicates
from paytide.llm.packing import pack
from paytide.llm.shards import uniform_shards
from paytide.llm.tokens import token_counts
from paytide.llm.vectors import near_duplicate_vectors
from paytide.llm.warc import read_archive, write_archive
from paytide.llm.whitening import whitened

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


#: A document is selected if it is of the best grade with this probability or more.
KEEP_FROM = 0.5


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit(quality.graded(docs, table(spark, sf_dir, "labels")))
    return quality.scored(docs, model, columns=["doc_id"]).withColumn(
        "kept", F.col("tail_probability") >= KEEP_FROM
    )


def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return uniform_shards(documents(spark, sf_dir), shards=24).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: Where a document is in the tree of files: its source, language and folder.
PATH = "concat(source, '/', lang, '/', doc_id % 50, '/', doc_id)"


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.license_scan(docs.select("doc_id", F.expr(PATH).alias("path"), "text"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op6_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), vocabulary="byte_bpe_50k.json", limit=512)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = secrets.fit(secrets.labelled_findings(docs))
    return secrets.find_secrets(docs, model).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
        "n_model",
        "n_confirmed",
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), vocabulary="byte_bpe_50k.json", capacity=2048, end_id=1)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(documents(spark, sf_dir))


# Host, path and action of the rules for pages.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    judged = urlfilter.judge_urls(pages, rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"), components=16)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_vectors,
        op3_shards,
        op4_licenses,
        op5_minhash,
        op6_leaks,
        op7_warc,
        op8_tokens,
        op9_secrets,
        op10_packing,
        op11_alignment,
        op12_urls,
        op13_whitening,
    )
}

#: The other operators have no SQL for whole tables; tests hold them against brute force.
SQL: dict[str, str] = {
    "op4_licenses": licenses.oracle(f"SELECT doc_id, {PATH} AS path, text FROM documents"),
    "op12_urls": urlfilter.oracle(URL_RULES),
}
