"""Raw rows by hand."""

from datetime import datetime

from pyspark.sql import functions as F

from sluiceworks.contract import Contract, Reference
from sluiceworks.operators.keyed import Limits

RUN_TS = datetime(2024, 1, 1)

# Every data-dependent choice takes the large-data way.
TINY = Limits(broadcast_rows=0, broadcast_bytes=0, task_rows=2, heavy_keys=50_000)

LAPS = Contract(
    "laps",
    "raceId INT NOT NULL, lap INT NOT NULL, pos INT, time STRING, speed DOUBLE",
    ("race_id", "lap"),
    {"lap_ge_1": "lap >= 1", "speed_ok": "speed IS NULL OR speed >= 0"},
    (Reference("race_id", "races", "race_id"),),
)
RACES = Contract("races", "raceId INT NOT NULL, year INT NOT NULL", ("race_id",))


def raw_rows(spark, contract, rows, file="hand.csv"):
    numbered = [(*r, i) for i, r in enumerate(rows)]
    schema = ", ".join(f"`{c.source}` string" for c in contract.columns) + ", _row_id bigint"
    return spark.createDataFrame(numbered, schema).withColumns(
        {"_source_file": F.lit(file), "_ingested_at": F.lit(RUN_TS).cast("timestamp")}
    )


def reasons(staged, *columns):
    """Sorted ``(original columns…, reasons)`` of all rows."""
    raw = [F.col(f"_raw_{c}").alias(f"r{i}") for i, c in enumerate(columns)]
    got = staged.rows.select(*raw, "_reasons").collect()
    return sorted([tuple(r) for r in got], key=repr)
