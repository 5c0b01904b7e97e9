"""The training-data pipeline: documents to packed token sequences.

Each stage calls one operator of ``mercato.llm`` on all rows its predecessor
kept; its result is written as Parquet and read again for the next one.  All
stages but the last return the columns of documents.

1. language: texts without a recognised language go (no letter, or no
   language has half of the letters);
2. near-duplicates: one document of each SimHash component stays (three-word
   shingles, two bits), that of the smallest doc_id;
3. decontamination: documents with at least a twentieth of their words in
   13-word windows of the benchmark go;
4. personal data: values become pseudonyms, and n_chars follows the text;
5. packing: pieces of token ids with their place in a sequence of 2048.

Null texts have no language and go with the first stage.  Other columns may
be null or repeated; columns beyond those of documents pass through the first
four stages.  An empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import decontamination, langid, packing, pii, simhash
from mercato.llm.common import crc32_of_id, read, set_aside, written

#: Least share of a text's letters that its language must have.
MIN_SCORE = 0.5

#: Not expressible in SQL (tests compare the stages with brute force).
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.where(crc32_of_id(F.col("doc_id")) % 5 != 0))
    return set_aside(docs, ["lang_pred", "score", "spans"], lambda d: langid.identify(d, model).where(
        (F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = read(spark, sf_dir, "benchmark")
    return set_aside(docs, ["n_words", "n_hit", "items", "contaminated"],
                     lambda d: decontamination.decontaminate(d, benchmark).where(~F.col("contaminated")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def masked(d: DataFrame) -> DataFrame:
        out = pii.pseudonymise(d)
        return out.withColumn("n_chars", F.when(F.col("n_values") > 0, F.length("text").cast(d.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))

    return set_aside(docs, ["n_values"], masked)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontaminate),
          ("personal_data", personal_data), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
