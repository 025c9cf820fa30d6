"""A training corpus from documents: toxicity, language, near-duplicates, secrets, packing.

Each stage works on all rows its predecessor kept, and its decisions take effect: toxic documents go, documents without
a recognisable language go, one document of each group of near-duplicates stays, secrets are replaced in the text, and
what is left is packed into sequences. All stages but the last return the columns of documents, in their order.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crosswalk.llm import language, packing, secrets, simhash, toxicity
from crosswalk.session import cut

MIN_LANGUAGE_SCORE = 0.3


def carried(docs: DataFrame) -> tuple[DataFrame, list[str], Callable[[DataFrame], DataFrame]]:
    """Documents whose columns beside id and text have neutral names, those names, and a function that puts the
    columns of documents back."""
    other = {c: f"_c{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    inner = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(n) for c, n in other.items()])

    def back(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(other.get(c, c)).alias(c) for c in docs.columns])

    return inner, ["text", *other.values()], back


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    inner, keep, back = carried(docs)
    chain = toxicity.fit_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return back(toxicity.score(inner, chain, keep=keep).filter(~F.col("toxic")))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters have no language. A low share of known words means that none of the learned languages
    fits; a low score, that several fit alike."""
    inner, keep, back = carried(docs)
    model = language.fit(docs)
    found = language.identify(inner, model, keep=keep, least=language.least_known(docs, model))
    return back(found.filter((F.col("lang_pred") != "und") & F.col("fits") & (F.col("score") >= MIN_LANGUAGE_SCORE)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group stays; among rows with that id the one with the smallest hash of its
    text, once. A null id comes after all others."""
    inner, _, back = carried(docs)
    hashed = inner.withColumn("_hash", F.xxhash64("text"))
    found = simhash.near_duplicates(hashed, keep=["_hash"])
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_hash")
    chosen = found.groupBy("root").agg(F.min(row).alias("row"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    stay = chosen.select(F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")).alias("_name"), F.col("row._hash").alias("_hash"))
    left = hashed.withColumn("_name", name).join(stay, ["_name", "_hash"], "left_semi")
    once = F.row_number().over(Window.partitionBy("_name", "_hash").orderBy("_name"))
    return back(left.withColumn("_once", once).filter("_once = 1"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; ``n_chars``, where there is such a column, follows."""
    inner, keep, back = carried(docs)
    found = secrets.scan(inner, keep=keep)
    out = found.withColumn("text", secrets.redacted(F.col("text"), F.col("spans")))
    if "n_chars" in docs.columns:
        n = keep[1 + [c for c in docs.columns if c not in ("doc_id", "text")].index("n_chars")]
        out = out.withColumn(n, F.when(F.size("spans") > 0, F.length("text")).otherwise(F.col(n)).cast(docs.schema["n_chars"].dataType))
    return back(out)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# Fitted models, hashes of shingles and tokenizers are beyond SQL; the tests hold the result against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
