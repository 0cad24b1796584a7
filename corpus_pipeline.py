"""The corpus pipeline: five stages over ``documents``.

Each stage works on all that its predecessor kept: quality rules drop what
they reject, near-dedup keeps one document of each class, personal data are
replaced, sources are mixed to their weights, and the mix is packed into
bins. All but the last return the columns of ``documents``.

Defined cases: null, empty and blank texts have fewer words than the base rule
asks for and go in the first stage; rows that agree in id and text are one
class, so one stays; a null source is a source of its own; columns beyond
those of ``documents`` are carried along, whatever their names; texts longer
than a bin are cut into pieces; without labels only the base rule rejects; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sigfleet.llm import mixing, near_dedup, packing, pii, quality_rules
from sigfleet.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep."""
    return quality_rules.filter_documents(spark, docs, table(spark, sf_dir, "labels"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup.dedup_documents(spark, docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and the terms that disclose them replaced."""
    return pii.sanitise_documents(spark, docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, each as often as it is taken."""
    return mixing.mix_documents(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin of every piece of every document of the mix."""
    return packing.packed_documents(spark, docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", dedup),
    ("pii", private),
    ("mixing", mix),
    ("packing", pack),
]

# The learned rules and the signatures are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
