"""A training-corpus pipeline: five stages over `documents`, each one operator of `entidex.llm`.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the next stage's docs. All but the last return the columns of `documents`; columns
that a table has besides pass through, whatever their names. An empty table goes through
every stage empty, and texts of any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entidex.llm import bpe, decontamination, jaccard, pii, rules
from entidex.llm.common import scratch, table, written
from entidex.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; the cutoffs are learnt from `labels`.

    A null or empty text has fewer than ten words and goes; repeated rows share their verdict.
    """
    return rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts stays: the one with the least id.

    Of equal ids the least text hash decides. Texts without words are linked with nothing and
    stay, as do rows without an id; of rows that repeat id and text one stays.
    """
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    A null or empty text holds none and stays; repeated rows go alike.
    """
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and revealing terms are replaced; `n_chars` follows the text.

    A null text stays null, as does its `n_chars`; repeated rows are changed alike.
    """
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, its text decoded from them, and its language and source.

    A null or empty text has no tokens and is decoded as empty; repeated rows repeat.
    """
    keyed = docs.select(F.struct("doc_id", "lang", "source").alias("doc"), "text")
    encoded = bpe.encode(keyed, tokenizer_path(), "doc")
    return encoded.select("doc.*", "ids", F.size("ids").cast("long").alias("n_tokens"), F.col("decoded").alias("text"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", encoding),
]

#: SQL cannot express byte-pair merges or overlapping spans; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs, folder = table(spark, sf_dir, "documents"), scratch(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), folder, str(i))
    return docs
