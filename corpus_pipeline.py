"""A corpus from raw documents to packed sequences, one written table per stage."""

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm import decontam, minhash, packing, quality, secrets
from riskloom.llm.common import by_document, free_names, same_document
from riskloom.llm.queries import table, tokenizer
from riskloom.session import checkpoint_dir

# Learned scores, alignments and packing have no SQL; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: five-word shingles, 80 of 100; of repeated rows, one.

    That is the one with the smallest id, missing ids last, also where ids repeat.  Documents without words stay.
    """
    found = minhash.near_duplicates(docs)
    counts = found.groupBy("id", "text_hash").agg(
        F.count("*").alias("rows"), F.min("chosen").alias("chosen"), F.max("n_shingles").alias("shingles")
    )
    odd = counts.where("NOT chosen OR (rows > 1 AND shingles > 0)").select("id", "text_hash", "chosen")
    rows, key = by_document(docs)
    names = docs.columns
    plain = rows.join(odd, same_document(rows, key, odd), "left_anti").select(names)
    again = odd.where("chosen")
    repeated = rows.join(again, same_document(rows, key, again), "left_semi")
    (number,) = free_names(rows, "__n")
    one = Window.partitionBy(*key).orderBy(F.lit(0))
    first = repeated.withColumn(number, F.row_number().over(one)).where(F.col(number) == 1).select(names)
    return plain.unionByName(first)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain an item of the benchmark."""
    found = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"))
    rows, key = by_document(docs)
    return rows.join(found, same_document(rows, key, found), "left_anti").select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks the secrets in all texts."""
    masked = secrets.redacted(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places the pieces of all documents in sequences."""
    return packing.pack(packing.pieces(docs, tokenizer()))


STAGES = [
    ("quality", classify_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each one's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
