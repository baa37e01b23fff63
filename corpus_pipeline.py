"""From raw documents to token ids: quality rules, near-duplicates, secrets, mixture, encoding.

Every stage takes all that the one before it kept. ``run`` writes each stage's result as
Parquet below the shared folder and reads it back, so a lost executor costs at most the
tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import bpe, minhash, mixing, quality, secrets
from ledgerlark.llm.common import sent_along, table, written
from ledgerlark.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; clean ones stay, as the cutoffs guarantee.

    Every row is judged by its own whole text, repeated rows alike; NULL and empty texts have no words and go. An empty
    table stays empty; other columns are dropped.
    """
    cutoffs = quality.select_cutoffs(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, cutoffs).where("kept").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8) stays.

    Of rows that repeat both id and text one stays, also of those with a NULL id; an id with several texts keeps all of
    them if it is kept. NULL and blank texts are linked with nothing, so only their repeats go. An
    empty table stays empty, long texts are compared whole, and other columns are dropped.
    """
    docs = docs.select(COLUMNS)
    found = minhash.near_duplicates(docs, size=5, percent=80)
    gone = written(found.where(~F.col("kept")).select("doc_id").distinct(), "pipeline-copies")
    kept = docs.join(sent_along(gone), "doc_id", "left_anti").select(COLUMNS)

    # Texts move only where a row is repeated.
    digest = F.md5(F.coalesce("text", F.lit("")))
    rows = docs.groupBy("doc_id", digest.alias("d"), F.col("text").isNull().alias("none")).count().where("count > 1")
    repeated = written(rows.select(F.col("doc_id").alias("r"), "d", "none"), "pipeline-repeated")
    if not repeated.count():
        return kept
    same = F.col("doc_id").eqNullSafe(F.col("r")) & (digest == F.col("d")) & (F.col("text").isNull() == F.col("none"))
    again = kept.join(repeated, same, "left_semi")
    return kept.join(repeated, same, "left_anti").unionByName(again.dropDuplicates(["doc_id", "text"]))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is masked; n_chars follows the new text.

    No row is dropped; NULL texts stay NULL with a NULL length, and long texts are scanned whole.
    """
    clean = secrets.redact_secrets(docs.select(COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated so that all sources weigh the same, and shuffled globally.

    A NULL source is one of its own. Sources without any text are left out; rows of one id get equal numbers of copies.
    """
    return mixing.mix(docs.select(COLUMNS)).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids instead of text; decoding them gives the text back. NULL and empty texts have no ids; no row is dropped."""
    coded = bpe.encode_documents(docs.select("doc_id", "source", "text"), tokenizer_path())
    return coded.select("doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# The cutoffs come from exact binomial tests and the ids from a tokenizer, so SQL can't say
# it; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace('_', '-')}")
    return docs
