import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from sluiceworks.llm import compression, queries

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def scored(spark, folder):
    larger = folder.replace("sf0.001", "sf0.01")
    found = queries.op11_quality_classifier(spark, larger)
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    return found, found.join(labels, "doc_id").collect()


def test_pieces_are_the_whole_text():
    text = ("word " * 1000 + "x" * 5000 + " é" * 900).encode()
    cut = list(compression.pieces(text, 512))
    assert b"".join(cut) == text
    assert max(map(len, cut)) <= 512
    assert list(compression.pieces(b"")) == []


def test_evidence_is_the_difference_of_compressed_sizes():
    good = [f"a sound sentence about topic {i} and its reasons. ".encode() * 3 for i in range(400)]
    bad = [f"BUY!! {i} | NOW!! | {i * 7} $$$ ".encode() * 4 for i in range(400)]
    both = compression.Pair(compression.dictionary(bad, 4096), compression.dictionary(good, 4096))
    for text in (good[7] * 40, bad[7] * 60, b"x", b"\x00\xff"):
        sizes = []
        for content in (compression.dictionary(bad, 4096), compression.dictionary(good, 4096)):
            c = zstandard.ZstdCompressor(
                level=compression.LEVEL, dict_data=zstandard.ZstdCompressionDict(content),
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            sizes.append(sum(len(c.compress(p)) for p in compression.pieces(text)))
        assert both.evidence(text) == pytest.approx((sizes[0] - sizes[1]) / len(text), abs=0.02)
    assert both.evidence(good[7]) > 0 > both.evidence(bad[7])
    assert both.evidence(b"") == 0


def test_held_out_accuracy(scored):
    found, labelled = scored
    held = [r for r in labelled if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in labelled)
    good = [r["predicted"] for r in held if r["quality"] == 1]
    bad = [r["predicted"] for r in held if r["quality"] == 0]
    assert sum(good) >= 0.95 * len(good)
    assert sum(bad) <= 0.2 * len(bad)
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in labelled)
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]


def test_held_out_labels_teach_nothing(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    turned = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    others = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    first, second = (
        {r["doc_id"]: r["score"] for r in compression.score(d, x).collect()} for d, x in ((docs, labels), (others, turned))
    )
    assert first == second


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(6, 1, 0), (6, 1, 0), (3, 1, 0), (9, 0, 0), (8, 0, 1), (None, 1, 1), (4, None, 0), (10, 0, 0)], LABELS)
    clash = odd.withColumns({"score": F.lit("s"), "label": F.lit(2), "evidence": F.lit(True), "_draw": F.lit(1)})
    found = compression.score(clash, labels.withColumn("text", F.lit("t"))).collect()
    assert len(found) == odd.count()
    assert all(0 <= r["score"] <= 1 for r in found)
    empty = {r["score"] for r in found if r["doc_id"] in (1, 2)}
    assert len(empty) == 1


def test_labels_of_one_class_or_none(spark, odd):
    one = spark.createDataFrame([(6, 1, 0), (3, 1, 0), (5, 0, 0)], LABELS)  # 5 is held out
    assert {r["predicted"] for r in compression.score(odd, one).collect()} == {1}
    none = spark.createDataFrame([], LABELS)
    assert {r["predicted"] for r in compression.score(odd, none).collect()} == {0}
    nothing = odd.limit(0)
    assert compression.score(nothing, one.unionByName(spark.createDataFrame([(9, 0, 0)], LABELS))).count() == 0


def test_samples_are_bounded(spark, documents):
    rows = documents.select("doc_id", F.lit(1).alias("label"), "text")
    whole = compression._samples(rows, {0: 0.0, 1: 1.0})[1]
    total = sum(map(len, whole))
    assert total == documents.agg(F.sum(F.octet_length("text"))).first()[0]
    some = compression._samples(rows, {0: 0.0, 1: 0.25})[1]
    assert 0.1 * total < sum(map(len, some)) < 0.4 * total
