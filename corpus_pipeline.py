"""The corpus pipeline: quality classifier, line dedup, near duplicates, decontamination,
SentencePiece.  Every stage is one operator over all the documents its predecessor kept;
all but the last return the columns of ``documents``.

Cases, in every stage: a null, empty or blank text is kept as it is; very long texts are
worked on whole; ties go by the smallest id; repeated rows are treated alike, and of equal
texts one stays after the near-duplicate stage; a null id is an id; an empty table gives an
empty result; further columns are returned as they are, whatever their names (but for
``ids``, which the last stage writes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoal.llm import classify, decontam, lines, pieces, setjoin
from shoal.llm.common import Scratch
from shoal.llm.queries import load, tokenizer_file


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted scorer doesn't reject as junk or toxic."""
    return classify.keep_good(docs, load(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated lines leave the texts, one line alone too; every document stays a row."""
    return lines.LineRuns(docs).cleaned(1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays: its smallest id."""
    return setjoin.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words are benchmark windows go."""
    return decontam.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids."""
    return pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]
# the classifier is fitted and the pieces are merged: SQL can't express either
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.table(docs, name)
    return docs
