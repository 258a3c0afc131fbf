"""From raw documents to packed training sequences, stage by stage.

Every stage reads what its predecessor kept as a Parquet table in the shared folder, so a lost
executor repeats tasks of one stage and lineage never grows. All but the last return the columns
of ``documents``; the last returns one row per packed piece.

Every stage takes null texts, null ids, repeated rows, empty tables and further columns of any name. Documents
with a null or empty text have no letter and go at the first stage. Rows that repeat id and text are one row
after the third. An empty ``documents`` gives no pieces, an empty ``benchmark`` removes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from usagetide.llm import decontaminate, language, neardup, packing, rules
from usagetide.llm.frames import table, written
from usagetide.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with enough confidence; texts without a letter, null ones among them, go.

    Where no document has a text and a language, none can be recognised and all go.
    """
    return language.accept(docs, language.fit(docs))


def by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy in force accepts; a null text has no words and goes."""
    return rules.accept(docs, rules.POLICIES["v1"])


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates; ones without an id stay where their group has no id."""
    return neardup.deduplicate(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage of weight; items without words match nothing."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in training sequences; an empty text is one piece of its end alone."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", by_language),
    ("quality_rules", by_rules),
    ("near_dedup", without_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: A trained classifier and packing have no SQL form; tests hold the stages against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
