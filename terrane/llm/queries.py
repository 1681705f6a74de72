"""The operators' registered queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm import bpe, flac, hilbert, langid, merkle, mixing, negatives, pii, repeats, secrets, shuffle, simhash, tokenfile
from terrane.llm.storage import saved


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN).drop("text")
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.grouped(docs, size=3, keep_text=False).select("doc_id", "fingerprint", "component_id")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(langid.remainder("doc_id") == 2, F.lit(False))
    model = langid.fit(docs, ~held_out)
    return langid.predicted(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    # The first four kinds are the base kinds.
    spans = pii.found(docs).drop("text").withColumn("base", F.expr("filter(pii, s -> s.number < 4)"))
    return spans.select(
        "doc_id",
        *[F.expr(f"CAST(size(filter(pii, s -> s.number = {i})) AS LONG) AS n_{k}") for i, k in enumerate(pii.KINDS[:4])],
        F.sha2(pii.joined("base").cast("binary"), 256).alias("base_sha256"),
        pii.joined("pii").alias("spans"),
    )


def op5_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return shuffle.shuffled(docs, 8).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    manifest = tokenfile.write_files(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenfile.read_files(manifest)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scanned(docs, keep_text=False).withColumn("base", F.expr("filter(secrets, s -> s.kind <> 'random')"))
    return found.select(
        "doc_id",
        *[F.expr(f"CAST(size(filter(secrets, s -> s.kind = '{k}')) AS LONG) AS n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.joined("base").cast("binary"), 256).alias("base_sha256"),
        secrets.joined("secrets").alias("spans"),
    )


def op9_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("payload"))
    docs = docs.withColumn("n_bytes", F.octet_length("payload").cast("long"))
    padded = f"rpad(payload, CAST(greatest({flac.BLOCK}, ceil(n_bytes / {flac.BLOCK}) * {flac.BLOCK}) AS INT), X'FF')"
    stored = saved(flac.encoded(docs.withColumn("payload", F.expr(padded)), "payload").drop("payload"), "flac")
    back = flac.decoded(stored).withColumn("payload", F.expr("unhex(array_join(transform(blocks, b -> hex(b.pcm)), ''))"))
    return back.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -32, 32)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mixed(docs, keep_text=False).select("doc_id", "size", "source_size", "target", "taken")


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return repeats.stripped(docs, keep_text=False).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    claimed = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    made = merkle.manifest(_table(spark, sf_dir, "documents"), ("doc_id", "source", "lang", "n_chars", "text"), "lang", "doc_id", claimed)
    return made.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(), 256).alias("proof_sha256"), "folded_root", "verified")


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_simhash": op2_simhash,
    "op3_langid": op3_langid,
    "op4_pii": op4_pii,
    "op5_shuffle": op5_shuffle,
    "op6_hilbert": op6_hilbert,
    "op7_tokenfile": op7_tokenfile,
    "op8_secrets": op8_secrets,
    "op9_flac": op9_flac,
    "op10_mixing": op10_mixing,
    "op11_repeats": op11_repeats,
    "op12_merkle": op12_merkle,
    "op13_negatives": op13_negatives,
}

ORACLE_SQL: dict[str, str] = {"op10_mixing": mixing.ORACLE_SQL, "op12_merkle": merkle.ORACLE_SQL, "op13_negatives": negatives.ORACLE_SQL}
