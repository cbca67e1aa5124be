"""Which reports are to be processed, and the table of those that have been."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unprocessed(reports: DataFrame, processed: DataFrame) -> DataFrame:
    """Reports whose hash no record has; records without a hash don't count."""
    done = processed.where("sha256 IS NOT NULL AND sha256 <> ''").select("sha256").distinct()
    return reports.join(done, "sha256", "left_anti")


def chosen(reports: DataFrame, names: DataFrame) -> DataFrame:
    """Reports whose path or file name is listed, whether processed or not; names: name.

    Two hash joins and a union, not one join on an OR, which would compare all pairs.
    """
    wanted = names.select(F.col("name")).distinct()
    by_path = reports.join(wanted, F.col("source_path") == F.col("name"), "left_semi")
    by_file = reports.join(wanted, F.col("source_path") == F.col("name"), "left_anti").join(wanted, F.col("file_name") == F.col("name"), "left_semi")
    return by_path.unionByName(by_file)


def upsert(processed: DataFrame, new: DataFrame) -> DataFrame:
    """processed without the records whose path or hash a new one has, and the new ones."""
    kept = processed.join(new.select("source_path").distinct(), "source_path", "left_anti").join(new.select("sha256").distinct(), "sha256", "left_anti")
    return kept.unionByName(new.select(*kept.columns))


def dashboard(reports: DataFrame, processed: DataFrame) -> DataFrame:
    """Reports, records and pending reports (never below 0) by company."""
    found = reports.groupBy("company").agg(F.count("*").alias("n_reports"))
    done = processed.groupBy("company").agg(F.count("*").alias("n_processed"))
    both = found.join(done, "company", "left").withColumn("n_processed", F.coalesce("n_processed", F.lit(0)))
    return both.withColumn("n_pending", F.greatest(F.col("n_reports") - F.col("n_processed"), F.lit(0)))


# Fixed value: what a file that is no report of its own ends in.
RECORD_ENDING = "_extraction_record.xlsx"


def discovered(files: DataFrame) -> DataFrame:
    """company, file_name, source_path, sha256, mtime and place of the PDF files of binaryFile rows (path, content,
    modificationTime) under companies/<company>/Financial_Statements, by lower-case name."""
    from pyspark.sql import Window as W

    company = F.regexp_extract("path", "(?:^|/)companies/([^/]+)/Financial_Statements/[^/]+$", 1)
    named = files.withColumn("company", company).where("company <> ''").withColumn("file_name", F.element_at(F.split("path", "/"), -1)).where(F.lower("file_name").endswith(".pdf"))
    place = F.row_number().over(W.partitionBy("company").orderBy(F.lower("file_name"), "path"))
    return named.select("company", "file_name", F.col("path").alias("source_path"), F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("mtime"), place.alias("place"))


def manifests(files: DataFrame) -> DataFrame:
    """company and seen, the hashes of a legacy manifest (company, text); text of any other shape has none."""
    raw = F.expr("try_variant_get(try_parse_json(text), '$.seen_hashes', 'array<string>')")
    return files.select("company", F.coalesce(raw, F.array().cast("array<string>")).alias("seen"))


def selected(reports: DataFrame, seen: DataFrame, explicit: DataFrame | None = None) -> DataFrame:
    """The reports whose path is listed, else those whose hash is not among seen (company, seen), in their order."""
    if explicit is not None:
        return reports.join(explicit.select(F.col("path").alias("source_path")).distinct(), "source_path", "left_semi")
    hashes = seen.select(F.explode("seen").alias("sha256")).distinct()
    return reports.join(hashes, "sha256", "left_anti")


def workbooks(files: DataFrame) -> DataFrame:
    """The distinct statement workbooks (company, path) that are there, no extraction records, with place by lower-case name
    among those of their company."""
    from pyspark.sql import Window as W

    name = F.lower(F.element_at(F.split("path", "/"), -1))
    kept = files.where(name.endswith(".xlsx") & ~name.endswith(RECORD_ENDING)).select("company", "path").distinct().withColumn("name", name)
    return kept.withColumn("place", F.row_number().over(W.partitionBy("company").orderBy("name", "path"))).drop("name")


def backfilled(reports: DataFrame, processed: DataFrame, files: DataFrame) -> DataFrame:
    """Reports without a record (company, file_name, sha256, ..) with the workbook <company>_<safe name>_statements*.xlsx
    that an earlier run left, the first by lower-case name; files: company, path.

    The safe name is cut out of the workbook's name, so that this is a hash join, not a LIKE over all pairs.
    """
    from ledgerloom.functions import labels

    name = F.element_at(F.split("path", "/"), -1)
    left = files.withColumn("name", name).where(F.lower("name").endswith(".xlsx") & ~F.col("name").endswith(RECORD_ENDING))
    # a safe name may itself hold "_statements", so each cut before one is a stem that the name fits
    stems = F.transform(F.sequence(F.lit(1), F.size(F.split("name", "_statements", -1)) - 1), lambda i: F.call_function("substring_index", F.col("name"), F.lit("_statements"), i))
    cut = left.where(F.contains("name", F.lit("_statements"))).select("company", "path", "name", F.explode(stems).alias("stem"))
    stem = F.concat("company", F.lit("_"), labels.safe_name(F.regexp_replace("file_name", r"(.)\.[^.]*$", "$1")))
    wanted = unprocessed(reports, processed).withColumn("stem", stem)
    first = wanted.join(cut, ["company", "stem"]).groupBy("company", "file_name", "source_path", "sha256").agg(F.min(F.struct(F.lower("name"), "path"))["path"].alias("output_workbook"))
    return first


def records(reports: DataFrame, outcomes: DataFrame, base: str, at) -> DataFrame:
    """Records of reports that succeeded, with paths relative to base; none of a company of which a report failed.

    reports: company, file_name, source_path, sha256, mtime; outcomes: company, source_path, output_path, error (null where
    the report succeeded); at: the time of the run.
    """
    failed = outcomes.where("error IS NOT NULL").select("company").distinct()
    good = outcomes.where("error IS NULL").join(failed, "company", "left_anti").select("source_path", "output_path")
    inside = lambda c: F.when(F.startswith(c, F.lit(base + "/")), F.substr(c, F.lit(len(base) + 2))).otherwise(c)
    joined = reports.join(good, "source_path")
    return joined.select("company", "file_name", inside(F.col("source_path")).alias("source_path"), "sha256", "mtime", inside(F.col("output_path")).alias("output_workbook"), F.lit(at).cast("timestamp").alias("processed_at"))


def summary(outcomes: DataFrame) -> DataFrame:
    """company, succeeded and failed reports of a run."""
    return outcomes.groupBy("company").agg(F.count_if(F.col("error").isNull()).alias("succeeded"), F.count_if(F.col("error").isNotNull()).alias("failed"))
