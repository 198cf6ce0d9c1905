"""A training corpus from raw documents, in five stages of the operators in ``tallyloom.llm``.

Each stage takes what the one before it has kept, written as Parquet and read again. ``run`` does that in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import contamination, jaccard, langid, lines, mixing
from tallyloom.llm.queries import MIX_DEFAULT_WEIGHT, MIX_SEED, MIX_WEIGHTS, language_model, table
from tallyloom.llm.storage import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a rejected one, as a text without letters, goes."""
    return langid.identify(docs, language_model(docs)).where(~F.col("rejected")).select(docs.columns)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; ``n_chars`` follows the text."""
    done = lines.dedup_lines(docs).select(docs.columns)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document with the smallest id."""
    return jaccard.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of any benchmark item."""
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in global order, with the columns that the mixing adds."""
    return mixing.mix_sources(docs, MIX_WEIGHTS, seed=MIX_SEED, default_weight=MIX_DEFAULT_WEIGHT)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", known_languages),
    ("line dedup", without_shared_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", uncontaminated),
    ("mixing to target weights", mixed),
]
# SQL can't express the language model of the first stage nor, at the size of a corpus, the pairs of the third.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERY = {"pipeline": run}
PIPELINE_ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
