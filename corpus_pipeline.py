"""A training corpus from raw documents: five stages, each an operator of ``eventlens.llm``.

Each stage takes (spark, docs, sf_dir) and works on everything that the stage
before it kept; ``run`` writes each stage's rows as Parquet and reads them back
as the next one's documents.  All stages but the last return the columns of
``documents``.

Every stage takes further columns, whatever their names, and gives them back (the
last one drops them); of an empty table it makes an empty one.  What nulls,
empty texts and repeated rows give is said per stage; very long texts are handled
whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm import pii, toxicity
from eventlens.llm.common import free_name, intermediates, read_table, stored, work_dir
from eventlens.llm.near_dup import near_duplicates
from eventlens.llm.pieces import load_model, round_trip
from eventlens.llm.queries import PIECE_MODEL, TOXIC_AT, learnable, mix_documents


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``TOXIC_AT``.

    The field is learnt from the labelled rows among ``docs``.  Texts without
    evidence, null and empty ones too, stay.
    """
    crf = toxicity.fit(docs, read_table(spark, sf_dir, "labels").where(learnable(F.col("doc_id"))))
    found = free_name(docs, "_toxicity")
    scored = toxicity.toxicity(docs, crf, out_col=found)
    return scored.where(F.col(f"{found}.score") < TOXIC_AT).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more).

    It is the one with the smallest id (of a group without ids, the one with
    the smallest row hash); of rows equal in id and text one stays.  Documents
    without words are in no group and all stay, but for repeated rows.
    """
    groups = stored(near_duplicates(docs), "dedup-groups")
    group = F.coalesce(F.col("component"), F.col("row_key"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    keep = groups.groupBy(group.alias("_group"), F.col("component").isNull().alias("_alone")).agg(F.min_by("row_key", order).alias("_keep")).select("_keep").distinct()
    row = free_name(docs, "_row")
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    return keyed.join(keep.withColumnRenamed("_keep", row), row, "left_semi").dropDuplicates([row]).select(*docs.columns)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data replaced by its kind, ``n_chars`` counted anew."""
    masked = pii.mask_personal_data(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents; one taken for several epochs is that many rows."""
    epochs = free_name(docs, "_epochs")
    mixed = mix_documents(docs, out_col=epochs)
    return mixed.withColumn(free_name(mixed, "_copy"), F.explode(F.sequence(F.lit(1), F.col(epochs).cast("int")))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_ids, ids`` of every row, by the vocabulary of ``PIECE_MODEL``,
    with the decoded text's ``decoded_sha256`` and ``round_trip``, whether it is the row's text."""
    return round_trip(docs, load_model(PIECE_MODEL)).select("doc_id", "lang", "source", "n_ids", "ids", "decoded_sha256", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", mask_pii),
    ("mixing", mix_sources),
    ("pieces", encode),
]

#: The stages fit models and sample by hash: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  What a stage's operators stored goes when its rows are written."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{work_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        with intermediates(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
