"""Corpus pipeline: from raw documents to sampled pieces, five stages over a whole table.

1. *language*: texts without a letter go, as they have no language. Where no text has a language to learn
   from, nothing is rejected.
2. *near_duplicates*: of each group of SimHash near-duplicates, the document with the smallest key stays.
3. *decontamination*: documents that hold a benchmark item go.
4. *personal_data*: personal data in texts is replaced by its kind; ``n_chars`` follows, where there is one.
5. *pieces*: texts become sampled SentencePiece ids, which decode to the same texts.

All stages keep every column of their input as it is, save for what is said above; the last adds
``piece_ids``, ``n_pieces`` and ``lossless`` (or a like name with underscores where that is taken).
Rows with null keys are documents like any other. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.llm import contamination, langid, pieces, pii, simhash
from smeltery.llm.packaging import shipped
from smeltery.llm.texts import fresh
from smeltery.sources.folders import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = (fresh(docs, "lang_pred"), fresh(docs, "lang_score"))
    network = langid.train(docs)
    if network is None:
        return docs
    return langid.predict(docs, network, into=names).where(F.col(names[0]) != langid.UNKNOWN).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return found
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def sampled_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = pieces.load()
    ids, back = fresh(docs, "piece_ids"), fresh(docs, "decoded")
    out = pieces.encode(docs, model, into=ids, back=back)
    return out.select(
        *docs.columns,
        ids,
        (F.length(ids) / 4).cast("bigint").alias(fresh(docs, "n_pieces")),
        F.col(back).eqNullSafe(F.col("text")).alias(fresh(docs, "lossless")),
    )


STAGES = [
    ("language", shipped(language)),
    ("near_duplicates", shipped(near_duplicates)),
    ("decontamination", shipped(decontamination)),
    ("personal_data", shipped(personal_data)),
    ("pieces", shipped(sampled_pieces)),
]

#: No SQL for the network, the latent search and the sampled pieces; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
