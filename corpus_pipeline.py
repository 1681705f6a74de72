"""A corpus pipeline: language, near-duplicates, personal data, mixture, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and gives the columns of
`documents`; the last gives token ids. `run` writes each stage's result as Parquet in the shared folder and reads it
back for the next, so a lost executor costs one stage at most.

In every stage repeated rows are rows of their own and an empty table gives an empty one. In all but the last, columns beyond
those of `documents` go along with their names and values, whatever the names are; the last gives an id, a count and the tokens.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm import bpe, langid, mixing, pii, simhash
from terrane.llm.storage import saved

#: A text whose most likely language has a smaller mean probability is no running text of a learned language.
LEAST_SCORE = 0.35


#: What the stages know by name; n_chars follows the text.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def carrying(stage: Stage) -> Stage:
    """A stage that meets other columns than `KNOWN` under neutral names only; they get their own back."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        other = {c: f"other{i}" for i, c in enumerate(docs.columns) if c not in KNOWN}
        return stage(spark, docs.toDF(*[other.get(c, c) for c in docs.columns]), sf_dir).toDF(*docs.columns)

    return run


@carrying
def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of running text in a learned language; null texts, those without letters and those of no clear language
    go. Null labels and null ids are no reason to go; without any label there is no language, and all go."""
    model = langid.fit(docs, ~F.coalesce(langid.remainder("doc_id") == 2, F.lit(False)))
    said = langid.predicted(docs, model)
    return said.where((F.col("lang_pred") != langid.UND) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


@carrying
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the least id (null last); of rows with the same id any
    one. Null texts and those without words are copies of one another."""
    return simhash.deduplicated(docs)


@carrying
def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts replaced by their kinds; n_chars follows the text. Null texts stay null."""
    out = pii.redacted(docs)
    out = out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out
    return out.select(*docs.columns)


@carrying
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0, 1 or 2 times): its share of taken words, rounded so that the words
    of each source stay what the mix takes of it. A document without words, or of null text, is no burden to the mix and
    stays; null is a source like any other."""
    mixed = mixing.mixed(docs, copies="copies")
    times = F.when(F.col("size") > 0, F.col("copies")).otherwise(1)
    return mixed.withColumn("times", times).where("times > 0").withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, as little-endian unsigned 32-bit integers; none for a null or empty text."""
    encoded = bpe.encode(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("language ID", keep_languages),
    ("SimHash near-dedup", drop_copies),
    ("PII", hide_personal_data),
    ("mixing sources", mix_sources),
    ("BPE", encode),
]

#: SQL has no CRF, XXH64 or BPE; the tests hold each stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
