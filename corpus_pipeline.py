"""Corpus pipeline: quality, near duplicates, contamination, mixing, token files.

``STAGES`` lists the stages in order.  Each is a function of (spark, docs, sf_dir) over
all documents its predecessor kept; ``run`` stores every stage's rows as Parquet in the
shared folder and reads them again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugemill.llm import copy_groups, decontaminate, mixing_tree, quality_vote, token_blocks
from gaugemill.llm.common import materialize, shipped, table
from gaugemill.llm.queries import tokenizer_path


@shipped
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the label model keeps."""
    return quality_vote.keep_good(docs)


@shipped
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id.

    Fingerprints two bits apart as in the SimHash operator, and five-word shingles alike
    to 0.8, which that radius does not reach.
    """
    return copy_groups.first_of_each(docs)


@shipped
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@shipped
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' targets ask for."""
    return mixing_tree.mixed(docs)


@shipped
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the written token files hold of each document."""
    return token_blocks.token_files(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("mixture", mixture),
    ("tokens", tokens),
]

# The label model, the components and the mix are not to be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
