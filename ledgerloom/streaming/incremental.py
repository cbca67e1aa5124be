"""Incremental runs with Structured Streaming: what has arrived is read once, recorded, and merged where it changes anything.

A target folder holds tables of Parquet, all by batch and company, so that a batch that is repeated after a failure writes the
same folders again and nothing twice:

* facts: the cells of every report that could be read,
* records: the reports that count as processed, as each batch recorded them,
* outcomes: what became of every report that was tried,
* waiting: reports of companies of which one failed; they are tried again with that company's next reports,
* merged: one merged statement per company and sheet, of the company's last batch.

A batch reads what the tables hold of the companies that its reports belong to, and of no other; without new files there is no batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators import merge, outcomes, registry

CELL = "sheet string, row_idx int, label string, period string, raw_text string"
REPORT = "company string, source_path string, sha256 string, mtime timestamp, text string"
#: So many companies of a batch are named in filters; more are joined.
LISTED = 10_000
TABLES = {
    "facts": f"company string, source_path string, sha256 string, {CELL}",
    "records": "company string, source_path string, sha256 string, mtime timestamp",
    "outcomes": "company string, source_path string, sha256 string, error string",
    "waiting": REPORT,
    "merged": "company string, sheet string, key string, position int, label string, period string, value decimal(28,8), workbook string",
}


def reports(spark: SparkSession, folder: str, schema: str = REPORT) -> DataFrame:
    """A stream over the Parquet files of a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def prepare(spark: SparkSession, target: str) -> None:
    """The target's tables, empty, where they are not there yet."""
    for name, schema in TABLES.items():
        keys = {"merged": ["company"]}.get(name, ["batch", "company"])
        columns = schema if name == "merged" else f"{schema}, batch long"
        spark.createDataFrame([], columns).write.mode("ignore").partitionBy(*keys).parquet(f"{target}/{name}")


def read(spark: SparkSession, target: str, name: str) -> DataFrame:
    columns = TABLES[name] if name == "merged" else f"{TABLES[name]}, batch long"
    return spark.read.schema(columns).parquet(f"{target}/{name}")


def _write(df: DataFrame, target: str, name: str, batch: int) -> None:
    """df as what the batch adds to a table, whatever a run of the batch before this one has left."""
    df.write.mode("overwrite").partitionBy("company").parquet(f"{target}/{name}/batch={batch}")


def alive(records: DataFrame) -> DataFrame:
    """The records that no later one of the same path or the same hash replaces: registry.upsert() over all batches."""
    last = lambda key: F.max("batch").over(W.partitionBy("company", key))
    told = records.withColumn("by_path", last("source_path")).withColumn("by_hash", last("sha256"))
    return told.where("batch = by_path AND batch = by_hash").drop("by_path", "by_hash")


def _first(df: DataFrame, key: str, *order) -> DataFrame:
    """One row of each key, the first in order."""
    return df.withColumn("nth", F.row_number().over(W.partitionBy("company", key).orderBy(*order))).where("nth = 1").drop("nth")


def _of(table: DataFrame, companies: DataFrame) -> DataFrame:
    """The rows of some companies; up to LISTED of them are a list, by which other companies' folders are not read at all."""
    names = [r["company"] for r in companies.select("company").distinct().limit(LISTED + 1).collect()]
    if len(names) > LISTED:
        return table.join(companies.select("company").distinct(), "company", "left_semi")
    return table.where(F.col("company").isin(names))


def ingest(stream: DataFrame, target: str, checkpoint: str, parse: Callable[[str], Iterable[tuple]], threshold: float = merge.THRESHOLD) -> StreamingQuery:
    """All new reports of the stream (REPORT), parsed, recorded, and their companies' statements merged again.

    parse makes CELL rows of a report's text; where it raises, the report's outcome is its error, no report of its company is recorded in
    this batch, and all of them wait for the company's next reports.  A report whose hash is recorded already is not parsed again; of
    reports that repeat a hash in one batch the first path counts, of those that repeat a path the latest.
    """
    spark = stream.sparkSession
    prepare(spark, target)
    key = ["company", "source_path", "sha256", "mtime"]

    def batch(new: DataFrame, number: int) -> None:
        new = new.select(*key, "text").where("company IS NOT NULL")
        # what the batch itself has written, should it be a repeated one, is of no account
        earlier = lambda name: _of(read(spark, target, name), new).where(F.col("batch") < number)
        known = alive(earlier("records"))
        # what arrives now comes before what has waited
        held = earlier("waiting").select(*new.columns, F.lit(1).alias("held"))
        every = _first(new.withColumn("held", F.lit(0)).unionByName(held), "sha256", "held", "source_path", F.desc("mtime"))
        tried = registry.unprocessed(_first(every, "source_path", "held", F.desc("mtime"), "sha256"), known).select(*new.columns)
        parsed = outcomes.each(tried, key, "text", parse, CELL)
        _write(parsed, target, "parsed", number)
        done = spark.read.schema(parsed.schema).parquet(f"{target}/parsed/batch={number}")
        _write(outcomes.results(done, "row_idx").drop("mtime"), target, "facts", number)
        status = outcomes.statuses(done, key)
        _write(status.drop("mtime"), target, "outcomes", number)
        failed = status.where("error IS NOT NULL").select("company").distinct()
        _write(tried.join(failed, "company", "left_semi"), target, "waiting", number)
        _write(status.join(failed, "company", "left_anti").drop("error"), target, "records", number)
        changed = read(spark, target, "records").where(F.col("batch") == number)
        recorded = alive(_of(read(spark, target, "records"), changed).where(F.col("batch") <= number)).drop("mtime")
        cells = _of(read(spark, target, "facts"), changed).join(recorded, ["company", "source_path", "sha256", "batch"], "left_semi")
        statements = merge.facts(cells.withColumnRenamed("source_path", "workbook").drop("sha256", "batch"))
        merged = merge.merged(statements, threshold).select(*[c.split()[0] for c in TABLES["merged"].split(", ")])
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("company").parquet(f"{target}/merged")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
