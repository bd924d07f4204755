"""From raw documents to packed sequences: five stages, each written before the next reads it.

Each stage takes a session, the documents that its predecessor kept and the
folder of the tables; all but the last give documents back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestrata.llm import decontamination, jaccard_join, packing, suffix_dedup, toxicity
from lodestrata.llm.common import prepare, read_table, stored
from lodestrata.llm.tokens import word_vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half; learned from labelled documents."""
    everything, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return toxicity.drop_toxic(docs, toxicity.fit_classifier(everything, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more, that of the least id."""
    prepare(spark)
    return jaccard_join.one_per_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document or place has, too."""
    prepare(spark)
    return suffix_dedup.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4,096 tokens."""
    prepare(spark)
    return packing.pack_documents(docs, word_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# A learned classifier and token ids are not to be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
