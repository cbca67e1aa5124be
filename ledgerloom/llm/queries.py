"""The corpus operators' queries over whole tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, digest_runs, filter_lattice, grammar_store, hard_negatives, near_copies, packing, progressive_jpeg, sanitise, style_tree, toxicity, warc
from .common import table


def op1_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op2_prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    whole = table(spark, sf_dir, "conversations").select(columns).unionByName(chat.probe(spark))
    return chat.digest(chat.examples(whole))


def op3_disclosure_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.report(table(spark, sf_dir, "documents"))


def op4_lexical_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.sequences(table(spark, sf_dir, "documents"), ids=False).drop("ids")


def op5_minhash_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(table(spark, sf_dir, "documents"), size=3, percent=85)


def op6_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progressive_jpeg.digest(progressive_jpeg.text_media(table(spark, sf_dir, "documents")))


def op7_prefix_filtered_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.linked(warc.derivatives(warc.responses(table(spark, sf_dir, "pages"))))


def op9_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.main_text(table(spark, sf_dir, "pages"))


def op10_repair_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grammar_store.read(grammar_store.write(table(spark, sf_dir, "documents")))


def op11_digest_run_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_runs.exact_copies(table(spark, sf_dir, "documents"))


def op12_filter_lattice_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_lattice.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_voronoi_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(rows["vec_id"] % 7 == 0, (rows["label"] + 1) % 10).otherwise(rows["label"])
    return hard_negatives.mine(hard_negatives.usable(rows, label), F.col("vec_id") % 50 == 0)


QUERIES = (
    op1_string_kernel_toxicity,
    op2_prefix_target_chat,
    op3_disclosure_sanitisation,
    op4_lexical_retrieval_packing,
    op5_minhash_near_copies,
    op6_progressive_jpeg,
    op7_prefix_filtered_decontamination,
    op8_warc_derivatives,
    op9_site_style_tree,
    op10_repair_token_store,
    op11_digest_run_copies,
    op12_filter_lattice_audit,
    op13_voronoi_hard_negatives,
)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_prefix_target_chat": chat.DIGEST_SQL,
        "op5_minhash_near_copies": near_copies.SQL,
        "op7_prefix_filtered_decontamination": decontaminate.SQL,
        "op11_digest_run_copies": digest_runs.SQL,
        "op12_filter_lattice_audit": filter_lattice.SQL,
        "op13_voronoi_hard_negatives": hard_negatives.SQL,
    }
