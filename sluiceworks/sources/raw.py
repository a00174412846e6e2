"""Raw tables: every value a string, plus where each row came from."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingested_at"
PROVENANCE = (SOURCE_FILE, INGESTED_AT)
ROW_ID = "_row_id"
# The whole text of a landed line with too few or too many fields; NULL for a good one.
MALFORMED = "_malformed"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A stored table with ``_row_id``: the file and the row's place in it.

    The id comes from the Parquet reader, so it does not change when a lost task is run again,
    whichever way the files are split.
    """
    return with_row_id(spark.read.parquet(path), by_name=True)


def with_row_id(scan: DataFrame, by_name: bool = False) -> DataFrame:
    """Adds ``_row_id`` to a DataFrame that is a plain Parquet scan.

    With ``by_name`` files that all lie in one folder are told by their names, which sort as their paths do: a path is
    often longer than the row that carries it.
    """
    short = by_name and len({file.rpartition("/")[0] for file in scan.inputFiles()}) == 1
    return scan.select(
        "*",
        F.struct(
            F.col("_metadata.file_name" if short else "_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        ).alias(ROW_ID),
    )


def native(column: str) -> str:
    """Where a raw table keeps the value that a text was made of, if it has one."""
    return f"_native_{column}"


def as_text(df: DataFrame, columns: list[str] | None = None, keep_native: bool = False) -> DataFrame:
    """The table as a landing file would hold it: strings only, nothing rounded. ``_row_id`` is kept.

    With ``keep_native`` the values themselves go along for the gate, which then need not parse what was printed a
    moment ago; texts are made only where they are asked for.
    """
    wanted = columns or [c for c in df.columns if c != ROW_ID]
    texts = [F.col(f"`{c}`").cast("string").alias(c) for c in wanted]
    kept = [F.col(f"`{c}`").alias(native(c)) for c in wanted if keep_native and df.schema[c].dataType != T.StringType()]
    return df.select(*texts, *kept, *[c for c in (ROW_ID,) if c in df.columns])


def well_formed(raw: DataFrame) -> DataFrame:
    """The rows that do not come from a malformed line."""
    return raw.where(F.col(MALFORMED).isNull()) if MALFORMED in raw.columns else raw


def stamped(raw: DataFrame, source_file: str | Column, run_ts: datetime) -> DataFrame:
    """Provenance columns: the file, and one time stamp for the whole run."""
    origin = F.lit(source_file) if isinstance(source_file, str) else source_file
    return raw.withColumns({SOURCE_FILE: origin, INGESTED_AT: F.lit(run_ts).cast("timestamp")})
