"""One query per operator, over the whole of the tables it is meant for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagscope.llm import decontaminate, interpolation, language, manifest, mixing, near, quality, search, secrets, substring_bytes, substring_words, tokens, toxicity
from lagscope.llm.oracles import ORACLES as ORACLES
from lagscope.llm.tables import held_out, read_table, stored
from lagscope.session import scratch_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def secrets_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))

    def of(kind: str):
        number = secrets.KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] < len(secrets.BASE_KINDS))
    return found.select(
        "doc_id",
        *(of(kind) for kind in secrets.BASE_KINDS),
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
        *(of(kind) for kind in secrets.ENTROPY_KINDS),
    )


def token_digests(files: tokens.TokenFiles, keys: DataFrame) -> DataFrame:
    """Per document of ``keys``, found through the index and read back from the shards."""
    located = stored(files.locate(keys, "doc_id"), "located")
    kind = keys.schema["doc_id"].dataType.simpleString()
    read = files.read(files.everywhere(located), tokens.crc_of, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
    return read


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    files = tokens.write_tokens(docs, scratch_dir(spark, "tokens"), TOKENIZER)
    return token_digests(files, docs)


def near_duplicates_tensored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, percent=80)


def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_bytes.dedup_bytes(read_table(spark, sf_dir, "documents"))


def repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_words.dedup_words(read_table(spark, sf_dir, "documents"))


def contamination_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.find_contamination(docs, benchmark)


def toxicity_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "toxic_spans")


def quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    ratios = quality.fit_ratios(docs, labels.filter(F.col("quality") == 1))
    return quality.judge_texts(docs, ratios).select("doc_id", *quality.COUNTS, "base_failed", "kept", "ratio")


def mixing_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language.fit_trees(docs.filter(~held_out(F.col("doc_id"))))
    predicted = language.predict_language(docs, model)
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def lexical_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return search.search(docs, benchmark).select("item_id", "rank", "doc_id", "score")


def deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = interpolation.score_texts(read_table(spark, sf_dir, "documents"))
    return scored.select(
        "doc_id", interpolation.held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def merkle_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    counted = [F.try_add("n_chars", F.lit(1)) if f == "n_chars" else F.col(f) for f in fields]
    found = manifest.build_manifest(docs, fields, received=F.when(tampered, manifest.row_hash(counted)))
    folded = manifest.fold(F.coalesce("received", "leaf"), F.col("steps"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_hash(F.col("steps")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_secret_entropy": secrets_entropy,
    "op2_token_files": token_files,
    "op3_toxicity_crf": toxicity_field,
    "op4_repeated_bytes": repeated_bytes,
    "op5_quality_ratio": quality_ratio,
    "op6_mixing_entropy": mixing_entropy,
    "op7_repeated_words": repeated_words,
    "op8_near_tensored": near_duplicates_tensored,
    "op9_contamination_seeds": contamination_seeds,
    "op10_language_ppm": language_ppm,
    "op11_lexical_signatures": lexical_signatures,
    "op12_deleted_interpolation": deleted_interpolation,
    "op13_merkle_intervals": merkle_intervals,
}
