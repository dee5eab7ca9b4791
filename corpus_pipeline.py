"""The training-text pipeline: grade, drop copies and near copies, decontaminate, mix.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns them, less those it
decides against. All but the last return the columns of `documents`; the last adds the place in the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgersift.llm import exact_dedup, pfair_mix, phrase_index, quality, simhash_trie
from ledgersift.llm.common import read_table, stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that more likely than not are good; the model is fitted on the rated ones.

    Null and empty texts score alike; equal texts share their fate; without ratings the odds are even and
    all documents stay.
    """
    model = quality.fit_quality(docs, quality.grades(read_table(spark, sf_dir, "labels")))
    return quality.keep_good(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal normalised texts, the one with the smallest id.

    Null texts are empty ones and form a group with those; a null id stays only in a group without other
    ids; rows that repeat the id and text that stay do so with it.
    """
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-equal fingerprints, the one with the smallest id.

    Null and wordless texts share a fingerprint, so one of them stays; rows that repeat id and text stay or
    go together.
    """
    return simhash_trie.drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of benchmark words.

    Null and empty texts have none and stay; rows that repeat id and text stay or go together.
    """
    return phrase_index.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mix of sources.

    A null source is a source; texts are not read, so null, empty and repeated ones are mixed like others;
    documents of equal hash are placed by id.
    """
    return pfair_mix.mix_sources(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("mixing sources", mix),
]

# A fitted classifier and SimHash are beyond SQL; tests hold the rows against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over `documents`; what a stage returns is written and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
