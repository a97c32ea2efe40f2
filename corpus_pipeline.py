"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), calls one operator of ``ledgerwalk.llm`` on all
that its predecessor kept, and returns a DataFrame; all but the last return the columns
of ``docs``. ``run`` writes each result as Parquet in the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerwalk.llm.common import one_row_per_id, store, table
from ledgerwalk.llm.line_dedup import dedup_lines
from ledgerwalk.llm.mixing import mix_documents
from ledgerwalk.llm.packing import packing_report
from ledgerwalk.llm.queries import tokenizer
from ledgerwalk.llm.simhash import simhash_groups
from ledgerwalk.llm.toxicity import fit_toxicity

#: Documents with this score or more are rejected.
TOXIC_FROM = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on labelled rows that aren't held out, doesn't reject.

    Null and empty texts are scored like any other and stay, as do rows without an id;
    repeated rows share their fate. Empty table: no rows. Other columns pass through,
    whatever their names.
    """
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).where(F.col("score") < TOXIC_FROM).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many share; ``n_chars`` follows the text.

    Null text becomes the empty one; a document that loses every line stays, empty. Rows
    without an id, repeated rows, ties and the empty table as ``dedup_lines`` says; other
    columns pass through, whatever their names.
    """
    d = dedup_lines(docs)
    own = {"doc_id": F.col("id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return d.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group (three-word shingles, three bits).

    Of rows that share an id one stays, by its text's hash. Rows without an id are in no
    group and all stay.
    """
    groups = simhash_groups(docs, shingle=3, distance=3)
    keep = store(groups.where(F.col("id") == F.col("component_id")).select(F.col("id").alias("keep_id")).distinct(),
                 "kept-ids")
    return one_row_per_id(docs, keep).unionByName(docs.where("doc_id IS NULL"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: documents as often as they are taken, in training order.

    Documents without a word (null, empty, blank) are taken no times; a null source is a
    source of its own; repeated rows count each. Empty table: no rows. Other columns pass
    through, whatever their names.
    """
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents and their places in sequences of 4096 ids.

    Null text is the empty one (a piece of one id); repeated rows and rows without an id
    are packed each; texts of any length are cut into pieces. Empty table: no rows. Other
    columns aren't read.
    """
    return packing_report(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup),
          ("mixing", mixing), ("packing", packing)]

#: A trained score can't be stated in SQL; tests/llm hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
