"""Landing files: CSV scans, the ingestion manifest and the presence check."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceworks.contract import Contract
from sluiceworks.sources.raw import INGESTED_AT, MALFORMED, SOURCE_FILE


def read_csv(spark: SparkSession, path: str, contract: Contract, run_ts: datetime) -> DataFrame:
    """A headed CSV file (or folder of them) as an all-string raw table with provenance.

    The schema is given, so no inference job runs; a header that differs from it is an error.
    ``\\N`` stays literal. Doubled quotes are read as quotes. ``_malformed`` holds the whole text of a
    line with too few or too many fields, which the reader pads or cuts; the gate quarantines it.
    """
    schema = T.StructType([*contract.raw_schema.fields, T.StructField(MALFORMED, T.StringType())])
    lines = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .csv(path)
    )
    return lines.select(
        "*",
        F.col("_metadata.file_name").alias(SOURCE_FILE),
        F.lit(run_ts).cast("timestamp").alias(INGESTED_AT),
    )


def manifest_frame(spark: SparkSession, expected: Mapping[str, int]) -> DataFrame:
    """``(dataset, expected_rows)``."""
    return spark.createDataFrame(sorted(expected.items()), "dataset string, expected_rows bigint")


def landed_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """One row per dataset found below ``folder``: files are listed, their content is not read.

    A dataset is a file ``<name><suffix>`` or a folder of that name holding part files.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(folder)
        .select("path", "length")
    )
    leaf = folder.rstrip("/").rsplit("/", 1)[-1]
    found = F.regexp_extract("path", rf"/\Q{leaf}\E/([^/]+?)\Q{suffix}\E(/|$)", 1)
    return (
        files.select(found.alias("dataset"), "length")
        .groupBy("dataset")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )


def presence(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """``(dataset, status)``: ``present``, ``missing`` (expected, not found) or ``extra``."""
    have, want = found.select("dataset").distinct(), manifest.select("dataset")
    return (
        have.join(want, "dataset", "left_semi")
        .withColumn("status", F.lit("present"))
        .unionByName(want.join(have, "dataset", "left_anti").withColumn("status", F.lit("missing")))
        .unionByName(have.join(want, "dataset", "left_anti").withColumn("status", F.lit("extra")))
    )


def require_present(statuses: DataFrame) -> None:
    """Fails naming the missing datasets; extra ones are allowed."""
    missing = [r.dataset for r in statuses.where("status = 'missing'").orderBy("dataset").collect()]
    if missing:
        raise FileNotFoundError(f"landing files missing for: {', '.join(missing)}")
