"""A corpus pipeline over ``documents``: language ID, near duplicates, secrets, mixing,
packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its
result is written as Parquet and read again as the next one's docs.  All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.llm import byte_convnet, curriculum, jaccard_join, packing, secret_scan
from vigil.llm.store import keep
from vigil.sources.tables import table

#: a text whose language is less certain than this goes
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that have a language: not ``und``, nor torn between several.  The
    given ``lang`` stays; where it is null, the predicted one is filled in.  Without labelled
    rows there is no model to judge by, and all documents stay."""
    model = byte_convnet.fit(docs)
    if model is None:
        return docs
    scored = byte_convnet.predict(docs, model)
    return (scored.where((F.col("lang_pred") != byte_convnet.UNKNOWN)
                         & (F.col("score") >= LEAST_SCORE))
            .withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: that with the smallest id (null last), then
    the smallest hash of its text.  Rows without words are no copies of anything and stay."""
    names = docs.columns
    docs = docs.withColumn("__text", F.xxhash64("text"))
    groups = jaccard_join.join(docs, tag=F.col("__text"))
    first = (groups.where("root IS NOT NULL").groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("r"))
             .select(F.col("r.doc_id").alias("__id"), F.col("r.tag").alias("__tag"), F.lit(True).alias("__one")))
    bare = (groups.where("root IS NULL").select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag"))
            .distinct().withColumn("__one", F.lit(False)))
    # plain columns without nulls as keys: the join's shuffle of texts then serves for the repeats too
    keys = ["__key", "__none", "__tag"]
    keyed = lambda df, c: df.withColumns(
        {"__key": F.coalesce(c, F.lit(0).cast("long")), "__none": F.col(c).isNull()}).drop("__id")
    kept = keyed(docs.withColumnRenamed("__text", "__tag"), "doc_id").join(keyed(first.unionByName(bare), "__id"), keys)
    once = kept.where("__one").dropDuplicates(keys)
    return once.unionByName(kept.where("NOT __one")).select(*names)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by its kind in brackets; all documents stay."""
    scanned = secret_scan.scan(docs, spans="__spans")
    hit = F.size("__spans") > 0
    clean = F.when(hit, secret_scan.redact(F.col("text"), F.col("__spans"))).otherwise(F.col("text"))
    return (scanned.withColumn("__clean", clean)
            .withColumn("n_chars", F.when(hit, F.length("__clean").cast("long"))
                        .otherwise(F.col("n_chars")))
            .withColumn("text", F.col("__clean")).select(*docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order; a copy taken in part has
    its first words."""
    mixed = curriculum.emit(curriculum.curriculum(docs, ordered=False))
    return (mixed.withColumn("n_chars", F.when(F.col("words") > 0, F.length("text").cast("long")))
            .select(*docs.columns))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all copies in windows of 4096 tokens, ids included."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mix", mix_sources),
    ("pack", pack_windows),
]

#: a trained network and an exact set join have no SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread; CRC-32 of each piece's ids."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return packing.piece_digests(docs)
