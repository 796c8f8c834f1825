"""A corpus pipeline over the documents table, as a part of the training-data operators.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir) and returns a table, which is written as
Parquet and read again as the next one's ``docs``. Language identification drops what it rejects, near-duplicate
detection keeps the first document of each group, substring dedup takes repeated passages out of the texts,
decontamination drops documents with benchmark passages, and packing lays out what is left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.functions.checkpoints import shared_folder
from graphloom.llm import decontamination, language_id, packing, simhash, substring_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is told with a margin, or that have one but no other language was learned. Where no row has a
    language nothing can be learned, told or rejected, and all rows stay."""
    learned = language_id.fit(docs)
    if not learned:
        return docs.select(COLUMNS)
    return language_id.identify(docs, learned).where("NOT rejected").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest key of each group stays; rows without a key are in no group and
    stay. Of rows that repeat a key, the first by text, language, source and length stays."""
    docs = docs.select(COLUMNS)
    firsts = simhash.simhash_groups(docs.where("doc_id IS NOT NULL")).where("doc_id = component_id").groupBy("doc_id").count()
    once = docs.join(firsts.where("count = 1").select("doc_id").hint("shuffle_hash"), "doc_id", "left_semi")
    one = F.row_number().over(Window.partitionBy("doc_id").orderBy("text", "lang", "source", "n_chars"))
    again = docs.join(firsts.where("count > 1").select("doc_id"), "doc_id", "left_semi").withColumn("__gl_row", one).where("__gl_row = 1")
    return once.select(COLUMNS).union(again.select(COLUMNS)).union(docs.where("doc_id IS NULL"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that lose words become the words left; a text that loses none stays as it is; one that loses all goes."""
    out = substring_dedup.substring_dedup(docs.select(COLUMNS))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    out = out.where("n_removed = 0 OR n_removed < n_units").withColumn("text", text)
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that a benchmark item leaks into go, each by its own text: with or without a key, which may be repeated."""
    return decontamination.without_leaks(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [("language_id", languages), ("near_duplicates", near_duplicates), ("substring_dedup", repeated_passages), ("decontamination", decontaminated), ("packing", packed)]

#: Compression, hashing by XXH64, edit distances and tokenizers have no SQL; the tests run a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. What each makes lies in the shared folder until the next one has been
    written; the input of the last, which runs when its rows are asked for, stays as long as the folder does."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    before = None
    for k, (name, stage) in enumerate(STAGES[:-1]):
        here = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(here)
        docs = spark.read.parquet(here)
        if before:
            path = spark._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        before = here
    return STAGES[-1][1](spark, docs, sf_dir)
