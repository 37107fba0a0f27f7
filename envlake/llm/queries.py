"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit as op13
from . import chat as op2
from . import decontaminate as op9
from . import html_text as op1
from . import jaccard as op10
from . import langid as op6
from . import licenses as op3
from . import lm as op8
from . import merkle as op11
from . import mixing as op4
from . import neighbours as op12
from . import secrets as op5
from . import topk as op7


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1.extract(_read(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id bigint, turn bigint, role string, text string")
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return op2.digests(op2.format_turns(rows))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3.scan(_read(spark, sf_dir, "documents")).drop("spans")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = op4.mix_sources(_read(spark, sf_dir, "documents"), op4.black_words())
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = op5.Scanner(spark, op5.dictionary_words(docs)).scan(docs)
    return found.select("doc_id", "start", "n_chars", F.sha2("candidate", 256).alias("candidate_sha256"), "score", "secret")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = op6.train(docs, ~op6.held_out())
    found = op6.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", op6.held_out().alias("held_out"), "lang_pred", "score")


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.search(op7.quantised(_read(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0, k=5)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _read(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    found = op8.cross_entropy_difference(_read(spark, sf_dir, "documents"), good)
    return found.select("doc_id", "n_tokens", *[F.round(c, 6).alias(c) for c in ("loss_target", "loss_background", "score")])


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op9.decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "items"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10.jaccard_components(_read(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.audit(_read(spark, sf_dir, "documents"))


def op12_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
