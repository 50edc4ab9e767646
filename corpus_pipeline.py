"""The corpus pipeline: five stages over ``documents``, each written as Parquet
in the shared folder and read again as the next one's input.

1. language ID: documents without a letter go, and those of whose n-grams every
   language holds less than three tenths (or half its usual share, where that is
   less) by more than chance explains in as few n-grams. Documents too short to
   tell stay, and all with a letter if nothing was learned of some language;
2. line dedup: lines found in ten documents or more go (an emptied document
   stays, with an empty text); ``n_chars`` follows the text;
3. Jaccard join: of each group of near duplicates one row stays, that with the smallest
   id (rows repeated under an id are judged by their own texts, and of equal ones
   one stays). Empty documents, and rows without an id, stay;
4. decontamination: documents that hold a benchmark item go;
5. packing: length buckets and token-budget batches (doc_id, n_tokens,
   bucket_tokens, batch_id, slot).

Null, empty and repeated rows are treated as each operator states; extra
columns are carried through stages 1 to 4. The stages that run Python set the
session's Arrow batches to 8 MB. SQL can't express stages 1, 4 and 5,
so there is no ``ORACLE_SQL``; the tests hold the stages against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flotilla.llm import decontaminate, jaccard, langid, linededup, packing
from flotilla.llm.shared import held_out, small_batches
from flotilla.session import cut_lineage

MIN_LANGUAGE_SCORE = 0.3
MIN_LINE_DOCUMENTS = 10


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the rows that aren't held out, judge all."""
    small_batches(spark)
    model = langid.fit(docs.filter(~held_out(F.col("doc_id"))))
    judged = langid.predict(docs, model, least=MIN_LANGUAGE_SCORE)
    # Two standard deviations at most; of overlapping n-grams one in GRAM tells something new.
    chance = F.sqrt(F.lit(float(langid.GRAM)) / F.greatest(F.col("n_grams"), F.lit(1)))
    low = (F.col("n_grams") > 0) & (F.col("excess") + chance < 0)
    return judged.filter((F.col("letters") > 0) & ~low).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Frequent lines go."""
    out = linededup.line_dedup(docs, min_docs=MIN_LINE_DOCUMENTS).select("row.*")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays."""
    small_batches(spark)
    return jaccard.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a verified benchmark item go."""
    small_batches(spark)
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(F.size("matches") == 0).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Buckets and batches of what is left, by words."""
    return packing.pack(docs, packing.word_count(F.col("text")))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
