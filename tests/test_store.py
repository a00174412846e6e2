import uuid

import pytest
from pyspark.sql import functions as F

from sluiceworks.operators.expectations import Expectation, ExpectationFailedError
from sluiceworks.session import workspace
from sluiceworks.sources import store, versions
from sluiceworks.sources.files import Files


@pytest.fixture
def schema(spark):
    name = "s" + uuid.uuid4().hex
    store.create_schema(spark, name, workspace(spark, name))
    yield name
    store.drop_schema(spark, name)


def keys(frame):
    return sorted(r["id"] for r in frame.collect())


def version_folders(spark, schema, name="t"):
    return [n for n in Files(spark, store.dataset_folder(spark, schema, name)).names() if n.startswith("version-")]


def test_replaced_with_another_schema_and_by_itself(spark, schema):
    store.overwrite(spark.range(4), f"{schema}.t")
    store.overwrite(store.read_table(spark, f"{schema}.t").selectExpr("id + 1 AS id", "'x' AS more"), f"{schema}.t")
    assert keys(spark.table(f"{schema}.t")) == [1, 2, 3, 4]
    assert spark.table(f"{schema}.t").columns == ["id", "more"]
    store.overwrite(spark.table(f"{schema}.t").where("id > 2"), f"{schema}.t")
    assert keys(spark.table(f"{schema}.t")) == [3, 4]
    assert len(version_folders(spark, schema)) == 1


def test_empty_table(spark, schema):
    store.overwrite(spark.range(0), f"{schema}.t")
    assert store.read_table(spark, f"{schema}.t").count() == 0


def test_a_write_that_dies_leaves_the_old_table(spark, schema, monkeypatch):
    store.overwrite(spark.range(3), f"{schema}.t")
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("x"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="x"):
        store.overwrite(broken, f"{schema}.t")
    assert keys(store.read_table(spark, f"{schema}.t")) == [0, 1, 2]
    # Killed in the middle: the folder stays, until a later version is committed.
    monkeypatch.setattr(versions.Version, "discard", lambda self: None)
    with pytest.raises(Exception, match="x"):
        store.overwrite(broken, f"{schema}.t")
    monkeypatch.undo()
    assert len(version_folders(spark, schema)) == 2
    assert keys(store.read_table(spark, f"{schema}.t")) == keys(spark.table(f"{schema}.t")) == [0, 1, 2]
    store.overwrite(spark.range(1), f"{schema}.t")
    assert len(version_folders(spark, schema)) == 1


@pytest.mark.parametrize("columns", ["id", "id, id AS more"])
def test_died_between_commit_and_catalog(spark, schema, monkeypatch, columns):
    store.overwrite(spark.range(3), f"{schema}.t")
    with monkeypatch.context() as m:
        m.setattr(store, "_show", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.overwrite(spark.range(5).selectExpr(*columns.split(", ")), f"{schema}.t")
    assert keys(spark.table(f"{schema}.t")) == [0, 1, 2]  # still whole
    assert keys(store.read_table(spark, f"{schema}.t")) == [0, 1, 2, 3, 4]
    assert keys(spark.table(f"{schema}.t")) == [0, 1, 2, 3, 4]


def test_table_lost_from_the_catalog(spark, schema):
    store.overwrite(spark.range(3), f"{schema}.t")
    spark.sql(f"DROP TABLE {schema}.t")
    assert keys(store.read_table(spark, f"{schema}.t")) == [0, 1, 2]


def test_a_pointer_cut_short_does_not_count(spark, schema):
    store.overwrite(spark.range(3), f"{schema}.t")
    files = Files(spark, store.dataset_folder(spark, schema, "t"))
    assert files.claim("_commits/00000002.json", '{"number": 2, "ver')
    assert keys(store.read_table(spark, f"{schema}.t")) == [0, 1, 2]
    store.overwrite(spark.range(1), f"{schema}.t")
    assert keys(store.read_table(spark, f"{schema}.t")) == [0]
    assert store.history(spark, f"{schema}.t")[-1].number == 3


def test_only_one_of_two_writers_commits(spark, schema):
    folder = store.dataset_folder(spark, schema, "t")
    first, second = versions.Version(spark, folder), versions.Version(spark, folder)
    for v, n in ((first, 2), (second, 3)):
        spark.range(n).write.parquet(v.path)
    store.publish(spark, schema, second, {"t": ("", spark.range(1).schema)})
    with pytest.raises(versions.OvertakenError):
        store.publish(spark, schema, first, {"t": ("", spark.range(1).schema)})
    assert keys(store.read_table(spark, f"{schema}.t")) == [0, 1, 2]
    assert len(version_folders(spark, schema)) == 1


def test_old_versions_can_be_kept(spark, schema):
    for n in (1, 2, 3):
        store.overwrite(spark.range(n), f"{schema}.t", keep=2)
    assert [c.number for c in store.history(spark, f"{schema}.t")] == [2, 3]
    assert len(version_folders(spark, schema)) == 2


def test_expectations(spark, schema):
    rows = spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0)], "id long, v double")
    with pytest.warns(UserWarning, match="2 rows miss positive"):
        stored = store.overwrite(rows, f"{schema}.t", [Expectation("positive", "v > 0"), Expectation("late", "id > 1", "drop")])
    assert keys(stored) == [2, 3]
    found = {r["expectation"]: (r["dataset"], r["action"], r["passed"], r["failed"]) for r in store.write_metrics(spark, schema).collect()}
    assert found == {"positive": ("t", "warn", 1, 2), "late": ("t", "drop", 2, 1)}
    with pytest.raises(ExpectationFailedError, match="2 rows"):
        store.overwrite(rows, f"{schema}.t", [Expectation("positive", "v > 0", "fail")])
    assert keys(store.read_table(spark, f"{schema}.t")) == [2, 3]
    with pytest.raises(ValueError, match="none of"):
        Expectation("x", "true", "stop")
