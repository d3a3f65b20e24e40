"""The corpus pipeline: the documents that are fit for training, packed into sequences.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept, and returns the columns of the
documents; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cambio.llm import langid, toxicity
from cambio.llm.common import id_remainder, read_table, written
from cambio.llm.minhash import drop_near_duplicates
from cambio.llm.packing import pack_documents
from cambio.llm.pii import sanitise
from cambio.llm.queries import TOKENIZER

#: A language that is less likely than this is as good as not determined.
LEAST_LANGUAGE_SCORE = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity reaches the threshold."""
    labels = read_table(spark, sf_dir, "labels")
    model = toxicity.learn(
        docs.where(id_remainder("doc_id", 4) != 2),
        labels.where(id_remainder("doc_id", 4) != 2),
        calibration=id_remainder("doc_id", 4) == 3,
    )
    return toxicity.drop_toxic(docs, model)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that have no letters or no likely language."""
    net = langid.learn(docs.where(id_remainder("doc_id", 5) != 0))
    return langid.keep_identified(docs, net, LEAST_LANGUAGE_SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked and revealing terms generalised or removed."""
    return sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens of what is left, a row per piece."""
    return pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language", keep_languages),
    ("near-duplicates", drop_copies),
    ("personal-data", mask_personal_data),
    ("packing", pack),
]

#: The learned stages cannot be said in SQL; the tests hold the pipeline against its stages run by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
