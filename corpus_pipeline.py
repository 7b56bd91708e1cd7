"""From ``documents`` to packed training sequences, in five stages.

Every stage takes what the one before kept, written as Parquet and read again: toxic documents go;
repeated lines go out of texts; of near-duplicates one document stays; contaminated documents go; the
rest is packed. All stages but the last return the columns of ``documents``, in their order. Empty
tables and null texts pass through; what each operator does with nulls, ties and repeated rows is said
in its module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokewise.llm import decontaminate, lines, packing, simhash, toxicity
from spokewise.llm.common import table
from spokewise.llm.queries import tokenizer_path
from spokewise.session import stored


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, docs.columns, "__toxicity")
    return scored.where("__toxicity.score < 0.5").select(docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without lines that occur, nearly or exactly, earlier."""
    done = lines.dedupe_lines(docs, docs.columns, counts=("__lines", "__lost"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.char_length("text").cast(kind)
        done = done.withColumn("n_chars", F.when(F.col("__lost") > 0, length).otherwise(F.col("n_chars")))
    return done.select(docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth lie in benchmark phrases."""
    judged = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), docs.columns, result="__found")
    hit = F.expr("__found.n_hit > 0 AND 20 * __found.n_hit >= __found.n_words")
    return judged.where(~hit).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in their sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("simhash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

#: No stage can be put in SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to ``documents``, each result stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
