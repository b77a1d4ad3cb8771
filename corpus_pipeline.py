"""A training corpus from raw documents: five stages, each a written table.

Every stage takes the rows that its predecessor kept and returns rows with the
columns of ``documents``; the last returns each row's place in the batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sitewise.llm import jaccard_groups, mixing, packing, suffix_dedup, toxicity
from sitewise.llm.common import Scratch, documents, load, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel classifier calls toxic go."""
    return toxicity.keep_clean(docs, load(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of the n-gram Jaccard join stays: five-word
    shingles, a similarity of 0.8."""
    return jaccard_groups.one_of_each(docs, shingle=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that stand anywhere else are cut from the
    texts.  Strings of 200 bytes are matched, which 50 words of three letters
    and a blank reach."""
    return suffix_dedup.remove_repeats(docs, match=200, gram=100, min_words=50)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped or repeated to meet the target weights, in training order."""
    return mixing.mixed_documents(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's length bucket, batch and slot."""
    return packing.pack(docs)


_between = Scratch()


def _cleaned(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``stage`` for a caller that writes each result before it asks for the
    next stage: the scratch tables of the stage before go first."""
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _between.drop(spark)
        with _between:
            return stage(spark, docs, sf_dir)
    return call


_STEPS = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [(name, _cleaned(stage)) for name, stage in _STEPS]

#: SQL cannot express the classifier; tests/llm holds the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and reread."""
    docs, own = documents(spark, sf_dir), Scratch()
    for _, stage in _STEPS:
        with own:
            docs = materialize(stage(spark, docs, sf_dir), keep=True)
        own.drop(spark)
    return docs
