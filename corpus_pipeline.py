"""A training corpus from raw documents: five stages, each an operator of envlake.llm.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and returns a DataFrame; all but the last return the columns of documents,
and any others that docs has, unchanged whatever their names. A row is its own
document: decisions find it by a key of its own, so rows that share an id, or have
none, are decided each by its text. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envlake.llm import decontaminate, jaccard, langid, mixing, secrets
from envlake.llm.store import written

#: A document whose best language has less than this probability is rejected, as is one without letters.
LEAST_LANGUAGE_SCORE = 0.4
#: Near copies share at least so many percent of their shingles of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _free(docs: DataFrame, name: str) -> str:
    """A column name like the given one that docs does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _no_more_files(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """kept with the columns of docs and no more partitions, so that a shuffle doesn't leave later stages many small files."""
    return kept.select(*docs.columns).coalesce(max(1, docs.rdd.getNumPartitions()))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier, learnt from these documents, recognises.

    A null or empty text, or one without letters, goes, and so does one without any
    likely language; whole texts of any length are read. Copies are decided alike. If no
    document has a language to learn from, none is recognised.
    """
    model = langid.train(docs, ~langid.held_out())
    label, score = _free(docs, "lang_pred"), _free(docs, "score")
    found = langid.predict(docs, model, label=label, score=score)
    return found.where((F.col(label) != "und") & (F.col(score) >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, an id before none.

    Texts that share 80 % of their five-word shingles are near copies, and a group is all
    that they reach; whole texts count. Of a document's repeated rows one stays. Null and
    empty texts are in no group and all stay. Of several rows with the smallest id any one.
    """
    key = _free(docs, "row")
    # written once, so that a row keeps its key whatever is computed again
    keyed = written(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    found = jaccard.jaccard_components(keyed.select(key, "text"), NEAR_WORDS, NEAR_PERCENT, doc_id=key)
    grouped = found.where("n_shingles > 0").select(F.col("doc_id").alias(key), "component_id").join(keyed.select(key, F.col("doc_id").alias("id")), key)
    first = grouped.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", key)).alias("first"))
    gone = grouped.join(first, "component_id").where(F.col(key) != F.col(f"first.{key}")).select(key)
    return _no_more_files(keyed.join(gone, key, "left_anti"), docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage: ten consecutive words of an item, or a whole shorter item.

    Null and empty texts stay; passages of any place in a text of any length count;
    copies go together. Rows are found again by a hash of their id and text.
    """
    key = _free(docs, "row")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = decontaminate.decontaminate(keyed.select(key, "text"), benchmark, doc_id=key)
    hit = found.where("contaminated").select(F.col("doc_id").alias(key)).distinct()
    return _no_more_files(keyed.join(hit, key, "left_anti"), docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets redacted and n_chars the length of what is left.

    A null text stays null and keeps its n_chars; texts of any length are scanned whole;
    copies are redacted alike.
    """
    scanner = secrets.Scanner(spark, secrets.dictionary_words(docs))
    redacted = scanner.redact(docs)
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")))
    return redacted.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes: a row for each, of these columns alone.

    Nothing is taken of a null or empty text; a null source is one, the last; repeated rows are documents of their own.
    """
    mixed = mixing.mix_sources(docs, mixing.black_words())
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
]

#: SQL can express neither the classifier nor the forest; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
