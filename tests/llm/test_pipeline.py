import os
import re

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from compare import connect, difference

from sluiceworks.llm import queries as registered


def test_registry():
    names = {re.match(r"op(\d+)_", n)[1] for n in registered.QUERIES}
    assert names == {str(n) for n in range(1, 14)}
    assert {*registered.QUERIES, "pipeline"} <= set(queries())
    assert set(registered.ORACLES) <= set(oracle_sql())


def test_oracles(spark, folder):
    con = connect(folder)
    for name, sql in registered.ORACLES.items():
        assert difference(registered.QUERIES[name](spark, folder), con, sql) is None, name


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first, before = docs.collect(), {r["doc_id"]: r for r in docs.collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.store(stage(spark, docs, folder), name)
        assert out.dtypes == docs.dtypes
        kept.append({r["doc_id"]: r for r in out.collect()})
        docs = out
    assert len(kept[0]) >= 0.98 * len(first)
    assert kept[1].keys() == kept[0].keys()
    assert any(kept[1][i]["text"] != before[i]["text"] for i in kept[1])
    assert all(len(r["text"]) == r["n_chars"] for r in kept[1].values())
    assert kept[2].keys() < kept[1].keys() and kept[3].keys() < kept[2].keys()
    packed = corpus_pipeline.best_fit_packing(spark, docs, folder).collect()
    assert {r["doc_id"] for r in packed} == set(kept[3])
    total = sum(r["length"] for r in packed)
    assert len({r["sequence_id"] for r in packed}) <= 1.02 * total / 2048 + 2
    run = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in run) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)


def test_the_rest_does_not_import_the_operators():
    root = os.path.dirname(corpus_pipeline.__file__)
    for at, _, files in os.walk(os.path.join(root, "sluiceworks")):
        if os.path.basename(at) != "llm":
            for name in files:
                if name.endswith(".py"):
                    with open(os.path.join(at, name)) as file:
                        assert not re.search(r"\bllm\b", file.read()), name
