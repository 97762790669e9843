"""Documents to tokens: drop toxic texts, keep one of each group of near copies, redact, mix, encode.

Each stage takes the whole output of the one before, and all but the last return the columns of
``documents``. Repeated rows, nulls and empty texts are treated as each operator's module says.
"""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import mixing, ngram_join, pieces, pii, toxicity
from skytally.llm.store import configured, saved, table
from skytally.session import use_work_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


@functools.cache
def _folder() -> str:
    return tempfile.mkdtemp(prefix="skytally-")


def _ready(spark: SparkSession) -> None:
    """Settings of the operators; a single-machine session that names no folder gets one for working tables."""
    configured(spark)
    if spark.sparkContext.master.split("[")[0] == "local" and not spark.conf.get("spark.checkpoint.dir", None):
        use_work_folder(_folder())


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels, does not take for toxic."""
    _ready(spark)
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: by five words, from a similarity of 0.8."""
    _ready(spark)
    return ngram_join.deduplicated(docs, shingle=5, percent=80)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; ``n_chars`` follows."""
    _ready(spark)
    return pii.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    _ready(spark)
    return mixing.resampled(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text."""
    _ready(spark)
    found = pieces.encoded(docs, lossless="lossless")
    return found.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids", "lossless")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_copies),
    ("personal data", without_personal_data),
    ("mixing sources", mixed),
    ("encoding", encoded),
]

#: Classifiers, hashes and keyed draws have no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
