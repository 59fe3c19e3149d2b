"""The corpus pipeline: documents to mixed, deduplicated token sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossline.llm import language, lines, minhash, mixing, sentencepiece
from lossline.llm.common import drop, fresh, intermediates, learnable, materialize, table


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is clear; ``lang`` becomes the language found."""
    model = language.fit(docs.where(learnable(F.col("doc_id"))).select("text", "lang"))
    found = language.identify(docs, model).where("NOT lang_rejected").withColumn("lang", F.col("lang_pred"))
    return found.select(*_columns(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated runs of lines; ``n_chars``, where there is one, follows the text. Documents stay."""
    cut = lines.dedup(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("ld_lines_removed") > 0, F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return cut.select(*_columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five-word shingles)."""
    return minhash.one_of_each(minhash.near_duplicates(docs, k=5, percent=80)).select(*_columns(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws whole documents to the source targets; one row for each copy taken."""
    mixed = mixing.mix(docs, mixing.label_weights(table(spark, sf_dir, "labels")), boundary="nearest")
    return (mixed.where("mix_copies > 0").withColumn(fresh(mixed, "mix_copy")[0], F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
            .select(*_columns(docs)))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, checked by decoding them."""
    return sentencepiece.encode(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]

ORACLE_SQL = None  # compression, rolling hashes and Viterbi are not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What the stages write in between is deleted as soon
    as the next stage's result is there."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with intermediates(spark) as made:
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
            result = made.pop()
        drop(spark, before)
        before = [result]
    return docs
