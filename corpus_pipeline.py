"""From raw documents to a training mix: five stages over the documents table.

What a stage writes for itself lies in a folder of its own. A stage that starts removes those of the
stages before, unless its documents still read from them: so write a stage's result down before you
start another one on something else.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.llm import langid, leaks, mixing, ngramjoin, substrings
from jobloom.llm.ship import ship_package
from jobloom.operators.publish import remove
from jobloom.session import scratch, shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_held: list[str] = []


def _release(spark: SparkSession, docs: DataFrame) -> None:
    """Remove the folders of earlier stages that `docs` does not read from."""
    files = docs.inputFiles() if _held else []
    for folder in list(_held):
        name = folder.rsplit("/", 1)[-1]
        if not any(name in f for f in files):
            remove(spark, folder)
            _held.remove(folder)


def in_own_scratch(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        _release(spark, docs)
        with scratch(spark, stage.__name__) as folder:
            _held.append(folder)
            return stage(spark, docs, sf_dir)

    return run_stage


@in_own_scratch
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, whichever language the mixture infers: no score is asked for, as no
    bound has been checked on clean documents. So only those without a letter go, also if no language
    can be learned."""
    return langid.keep_identified(docs)


@in_own_scratch
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more)."""
    return ngramjoin.keep_one_row(docs, n=5, percent=80)


@in_own_scratch
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages are cut out of the texts; n_chars follows."""
    cut = substrings.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@in_own_scratch
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return leaks.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@in_own_scratch
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents that it takes words of, with how many; the others go."""
    return mixing.mix_documents(docs)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix_sources),
]

# Hashed draws and inferred languages have no SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each written down and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark, "corpus-pipeline")
    for i, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        done.write.parquet(f"{folder}/{i}")
        if i:
            remove(spark, f"{folder}/{i - 1}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
