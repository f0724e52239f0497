"""The queries of this subpackage over the given tables, and the SQL twins of those that SQL can express."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import base
from ..session import configure, kept
from . import bpe, decontaminate, licenses, merkle, neighbours, ngrams, packing, periodic, pii, simhash, substring, tokens, toxicity

QUERIES: dict[str, base.Query] = {}
ORACLES: dict[str, str] = {}


def query(make: base.Query) -> base.Query:
    QUERIES[make.__name__] = make
    return make


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(modulus: int) -> Column:
    """crc32 of the id as text, modulo a number; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data."""
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


@query
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's score under the model of those that are not held out."""
    return ngrams.score(table(spark, sf_dir, "documents"), remainder(10) == 0)


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct length with its sums."""
    return tokens.suffix_sums(kept(tokens.length_histogram(table(spark, sf_dir, "documents")), "lengths"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's score; rows with remainder 0 teach nothing."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder(5) != 0)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document."""
    return substring.kept_digest(substring.remove_repeats(table(spark, sf_dir, "documents")))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece with its place."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


@query
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest rows of each fiftieth one."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of a benchmark item in a document."""
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licence statements."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs; a tenth of the texts are made to repeat."""
    docs = table(spark, sf_dir, "documents")
    return periodic.digest(periodic.find_runs(docs.select("doc_id", periodic.with_repeats(F.col("doc_id"), F.col("text")).alias("text"))))


@query
def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's ids, and the text that they give."""
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, checked against a third of the documents in lower case."""
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = merkle.checked(merkle.manifest(docs, F.col("lang"), F.col("doc_id"), merkle.leaf(*fields, F.col("text")),
                                           F.when(remainder(3) == 0, merkle.leaf(*fields, lower))))
    return found.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


ORACLES["op10_licenses"] = licenses.sql_twin()


def queries() -> dict[str, base.Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
