"""A training corpus from raw documents: five stages, each over all rows the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
Between stages the rows are written as Parquet and read again, so a stage never replays the ones before.

Defined results: texts that are NULL or empty pass all stages (of several, which are copies of each other, the one of the smallest id
stays) and are packed as the end token alone. Rows without an id are never toxic for want of a label, in no class of
near duplicates and in no other row's way, so they stay, whole, unless they are toxic or hold a benchmark passage. Of rows that repeat
an id one stays. NULLs in other columns, and columns of any name besides those of ``documents``, pass unchanged up to packing.
Without labels of both classes nothing is rejected as toxic; an empty benchmark rejects nothing; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordertide.llm import decontaminate, near_dedup, queries, substrings, toxicity
from ordertide.llm.common import materialise, read_table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; a model that tells no texts apart rejects none."""
    model = queries.toxicity_model(docs, read_table(spark, sf_dir, "labels"))
    if not model.weights:
        return docs
    return toxicity.accepted_rows(docs, "text", model, queries.TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of smallest id stays."""
    return near_dedup.first_of_each(docs, "doc_id", "text")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that a document of smaller id also has are cut out."""
    return substrings.cleaned(docs, "doc_id", "text", "n_chars")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.clean_rows(docs, read_table(spark, sf_dir, "benchmark"), "item_id", "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences."""
    return queries.packed_documents(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: No SQL: the stages learn a classifier, sketch texts and tokenise.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
