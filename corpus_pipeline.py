"""A corpus from raw documents to token files, in five stages.

Each stage is (spark, docs, sf_dir) -> DataFrame and works on all that the stage before it kept; ``run`` writes
every stage to the shared folder and reads it back for the next.

1. language       documents without a known language go (operator 1, fitted on the labelled ones)
2. near_dedup     one document of each group of near copies stays: five-word shingles, 0.8 (operator 10)
3. decontaminate  documents that hold a benchmark item go (operator 5)
4. mix            whole documents are taken 0 to 3 times, to the target weights of their sources (operator 9)
5. tokens         what is left is written as bit-packed token files and read back (operator 6)

Edge cases, in every stage: an empty table gives an empty one; very long texts are done whole; columns besides
doc_id, text, lang and source go through the first four stages as they are, whatever their names.

No SQL expresses the whole; tests/llm/test_pipeline.py checks the rows against plain Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waymesh.llm import op01_language, op05_decontamination, op06_token_ids, op09_mixing, op10_minhash
from waymesh.llm.common import durable, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and empty texts, and those without letters, have no language and go; so does everything where no row is
    labelled. Ties between languages go to the one that sorts first. Repeated rows are judged alike; rows without
    doc_id are judged but not learned from. A null lang is filled with the prediction."""
    return op01_language.accepted(docs, op01_language.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group the smallest doc_id stays, at a tie the smallest text hash, of equal rows one; different texts under
    one doc_id are different documents. Null and empty texts are alike nothing and stay. A row without doc_id stays
    only where its group has none with one."""
    return op10_minhash.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share a doc_id go or stay together; rows without doc_id, and null and empty texts, stay. Repeated rows
    are judged alike, ties between items do not matter: one is enough."""
    return op05_decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and empty texts have no words and are not taken. A null source is a source of its own. Rows equal in
    doc_id, source and text stand for each other where the budget ends among them; keys tie by doc_id, then text."""
    return op09_mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A null or empty text is the end id alone; a null doc_id sorts first; rows that tie on doc_id, and repeated rows,
    are all written, in the order of their text. Other columns end here."""
    return op06_token_ids.read_token_files(op06_token_ids.write_token_files(docs))


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
