"""The registered queries of this subpackage: name to ((spark, sf_dir) -> DataFrame, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skytally.llm import centroids, chat, fingerprint, licenses, lines, lm, mixing, ngram_join, pieces, pii, runs, topk, toxicity
from skytally.llm.store import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = (function, sql)
        return function

    return add


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op9(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op1(table(spark, sf_dir, "documents"))


@query()
def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.op10(table(spark, sf_dir, "documents"))


@query(chat.SQL)
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op4(table(spark, sf_dir, "conversations"))


@query(topk.SQL)
def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.op8(table(spark, sf_dir, "embeddings"))


@query()
def op3_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.op3(table(spark, sf_dir, "documents"))


@query()
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op7(table(spark, sf_dir, "documents"))


@query()
def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.op2(table(spark, sf_dir, "documents"))


@query(ngram_join.SQL)
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.op6(table(spark, sf_dir, "documents"))


@query()
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op5(table(spark, sf_dir, "pages"))


@query()
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.op13(table(spark, sf_dir, "documents"))


@query(centroids.SQL)
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.op11(table(spark, sf_dir, "embeddings"))


@query(lines.SQL)
def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.op12(table(spark, sf_dir, "documents"))
