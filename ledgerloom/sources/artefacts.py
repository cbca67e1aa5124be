"""The small outputs of a run as text files by report or company: JSON records, page texts, hash manifests, configurations.

Each is one row of text, written by Spark under folders of its keys; writing again replaces just the folders of what is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _write(df: DataFrame, path: str, keys: list[str]) -> None:
    df.select(*keys, "text").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("lineSep", "\n").partitionBy(*keys).text(path)


def _there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _whole(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The key columns and the whole text of every file; no rows where nothing has been written yet."""
    if not _there(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).text(path, wholetext=True)


def _in_order(df: DataFrame, but: list[str]) -> Column:
    """A row as JSON, its keys in order, nulls too."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns) if c not in but]), {"ignoreNullFields": "false"})


def write_json(df: DataFrame, path: str, keys: list[str]) -> None:
    """One JSON text for each row, such as a report's metadata or its candidates."""
    _write(df.select(*keys, _in_order(df, keys).alias("text")), path, keys)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What write_json has written, as schema (its first column is the key); nothing written means no rows."""
    key, *rest = schema.split(", ")
    texts = _whole(spark, path, f"text string, {key}")
    return texts.select(key.split()[0], F.from_json("text", ", ".join(rest)).alias("row")).select(key.split()[0], "row.*")


def write_pages(pages: DataFrame, path: str) -> None:
    """The text of each page (doc_id, page_number, text) in a file of its own."""
    _write(pages, path, ["doc_id", "page_number"])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    texts = _whole(spark, path, "text string, doc_id string, page_number int")
    # a file ends with the end of its last line
    return texts.select("doc_id", "page_number", F.regexp_replace("text", "\n$", "").alias("text"))


def write_manifests(seen: DataFrame, path: str) -> None:
    """The hashes (company, sha256) of a company's reports as one manifest."""
    hashes = seen.where("sha256 IS NOT NULL").groupBy("company").agg(F.array_sort(F.collect_set("sha256")).alias("seen_hashes"))
    write_json(hashes, path, ["company"])


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    from ledgerloom.operators import registry

    return registry.manifests(read_texts(spark, path))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """company and text of what is written by company."""
    return _whole(spark, path, "text string, company string").select("company", "text")


def write_configurations(keywords: DataFrame, records: DataFrame, path: str) -> None:
    """Each company's configuration, of version 1: its keywords (company, statement_type, keyword) and the records of its reports."""
    words = keywords.groupBy("company", "statement_type").agg(F.array_sort(F.collect_set("keyword")).alias("words"))
    words = words.groupBy("company").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("statement_type", "words")))).alias("statement_keywords"))
    columns = [c for c in records.columns if c != "company"]
    done = records.groupBy("company").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("processed_reports"))
    every = words.join(done, "company", "full").withColumn("config_version", F.lit(1))
    write_json(every, path, ["company"])
