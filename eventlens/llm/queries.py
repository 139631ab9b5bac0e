"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pii, toxicity
from .ann import nearest
from .common import read_table
from .exact_dedup import exact_duplicates
from .fingerprint import fingerprints_with_next
from .licenses import scan_licenses
from .lm_score import stupid_backoff
from .merkle import merkle_manifest, verified
from .mixing import mix
from .near_dup import near_duplicates
from .pieces import load_model, round_trip
from .sharding import shard_records
from .whitening import fit_whitening, whiten

#: Vocabulary of op8 and of the pipeline's last stage.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _digest(base: Column) -> Column:
    """``kind:start:stop`` of spans, comma-joined."""
    return F.array_join(F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op1_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def rank(s: Column) -> Column:
        return F.array_position(F.array(*[F.lit(k) for k in pii.KINDS]), s["kind"])

    spans = F.array_sort(F.concat("base", "added"), lambda x, y: F.when(x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(F.signum(rank(x) - rank(y))).cast("int"))
    return found.select("doc_id", *map(count, pii.BASE_KINDS), F.sha2(_digest(F.col("base")).cast("binary"), 256).alias("base_sha256"), _digest(spans).alias("spans"))


def op2_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), n=2).select("doc_id", "n_shingles", "component_id", "kept")


def source_domain(source: Column) -> Column:
    """Four domains by the source's number; sources without a number form one of their own."""
    return F.regexp_extract(source, "([0-9]+)$", 1).try_cast("long") % 4


#: Weights of languages inside each domain, and those of domains; sources weigh alike.
DOMAIN_WEIGHTS = [(0, 3.0), (1, 2.0), (2, 2.0), (3, 1.0)]
LANGUAGE_WEIGHTS = {"en": 4.0, "fr": 2.0, "de": 2.0, "es": 1.0}
MIX = {"budget_share": 0.5, "max_epochs": 3, "seed": 13}


def mix_documents(docs: DataFrame, id_col: str = "doc_id", out_col: str = "epochs") -> DataFrame:
    """``docs`` mixed by domain, language and source with the weights above."""
    spark = docs.sparkSession
    domains = spark.createDataFrame(DOMAIN_WEIGHTS, "level0 long, weight double")
    langs = spark.createDataFrame([(d, name, w) for d, _ in DOMAIN_WEIGHTS for name, w in LANGUAGE_WEIGHTS.items()], "level0 long, level1 string, weight double")
    return mix(docs, [source_domain(F.col("source")), F.col("lang"), F.col("source")], id_col=id_col, weights={0: domains, 1: langs}, out_col=out_col, **MIX)


def op3_budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(read_table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "epochs")


def learnable(doc_id: Column) -> Column:
    """Whether labels of the row may be learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


TOXIC_AT = 0.7


def op5_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    crf = toxicity.fit(docs, labels.where(learnable(F.col("doc_id"))))
    scored = toxicity.toxicity(docs.select("doc_id", "text"), crf)
    held_out = F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out")
    score = F.col("toxicity.score")
    return scored.select("doc_id", held_out, score.alias("score"), (score >= TOXIC_AT).cast("int").alias("predicted"), F.col("toxicity.spans").alias("toxic_spans"))


def op8_streaming_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return round_trip(docs.select("doc_id", "text"), load_model(PIECE_MODEL)).select("doc_id", "n_ids", "ids", "decoded_sha256", "round_trip")


def op4_splitter_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_records(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints_with_next(read_table(spark, sf_dir, "documents"))


def op6_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stupid_backoff(read_table(spark, sf_dir, "documents"), order=3)


def op9_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.array_max(F.transform("licenses", lambda x: F.struct(x["coverage"], x["license"])))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), best["license"].alias("license"), F.coalesce(best["coverage"], F.lit(0.0)).alias("coverage"), "licenses")


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claimed = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    return verified(merkle_manifest(docs, MANIFEST_FIELDS, "lang", "doc_id", claimed), "doc_id")


def op12_exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return whiten(vectors, fit_whitening(vectors))


def op13_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_weak_supervision_pii": op1_weak_supervision_pii,
    "op2_bbit_minhash": op2_bbit_minhash,
    "op3_budget_mix": op3_budget_mix,
    "op4_splitter_shards": op4_splitter_shards,
    "op5_crf_toxicity": op5_crf_toxicity,
    "op6_stupid_backoff": op6_stupid_backoff,
    "op7_weighted_fingerprints": op7_weighted_fingerprints,
    "op8_streaming_viterbi": op8_streaming_viterbi,
    "op9_cross_polytope": op9_cross_polytope,
    "op10_patience_licenses": op10_patience_licenses,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_exact_whitening": op12_exact_whitening,
    "op13_chunk_recipes": op13_chunk_recipes,
}
