"""The corpus as a chain of stages, each written as Parquet and read again by the next one.

Every stage but the last takes documents and returns documents: rejected ones are gone, texts are as the stage left them, and
n_chars follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urndraw.llm import langid, linededup, packing, pii, similar
from urndraw.llm.common import read, stored
from urndraw.llm.queries import BYTE_BPE, vocabulary

#: A document whose best language has a share of less than this above an even one has none.
ABOVE_EVEN = 0.05


def _recounted(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with n_chars for the text as it is now."""
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; null text, text without letters and text in no one language go."""
    model = langid.train(docs)
    found = langid.with_language(docs, model)
    least = 1 / len(model.languages) + ABOVE_EVEN if len(model.languages) > 1 else 0.0
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that an earlier one has; those of which nothing is left go."""
    found = linededup.dedup_lines(docs)
    return _recounted(found.where("n_removed = 0 or n_removed < n_lines"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles, the one with the lowest id."""
    return similar.one_of_each(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the kind of personal data in its place."""
    return _recounted(pii.redacted(docs, pii.train(docs)), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    cut = packing.pieces(docs, vocabulary(BYTE_BPE))
    return packing.assign(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("lines", drop_repeated_lines),
    ("near_copies", drop_near_copies),
    ("personal_data", remove_personal_data),
    ("packing", pack),
]
#: Shingle hashes, trained models and token ids have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
