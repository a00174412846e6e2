r"""Cross-site line dedup from distinct-site sketches, in DataFrame operations only.

A line is boilerplate if it stands on ``min_sites`` or more distinct sites (``source``). One HyperLogLog
sketch of sites per line hash is built beside the text and merged by aggregation; lines whose estimate is
near the threshold are counted exactly, the others are as far from it as the sketch's error allows. A
boilerplate line stays in the first document (smallest id) that has it, so a text that is mirrored on many
sites keeps one full copy, and goes from all others. ``without_passages`` does the same with every line of
``PASSAGE_WORDS`` words or more that stands in two documents, whatever their sites.

Lines are split at ``\n`` and compared without white space at their ends, by a 64-bit hash. Defined results:
blank lines are never boilerplate; NULL and empty texts stay as they are; a text that loses all lines
becomes empty. A NULL source is a site of its own. NULL ids are never first while another id has the line;
rows with the same id (NULL included) are one document. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.common import free, spread_join, store

MIN_SITES = 5
PASSAGE_WORDS = 50
LG_K = 10
BLANK = " \t\n\x0b\x0c\r"
# Drop lists of up to this many line hashes are broadcast (8 bytes each); longer ones are shuffled.
SMALL_DROPS = 500_000


def _hash(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(BLANK)))


def occurrences(docs: DataFrame, min_words: int = 1) -> DataFrame:
    """``doc, site, key`` of every line of ``min_words`` words or more."""
    site = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    lines = docs.select(F.col("doc_id").alias("doc"), site.alias("site"), F.explode(F.split("text", "\n")).alias("line"))
    there = F.btrim("line", F.lit(BLANK)) != ""
    if min_words > 1:  # as many words have as many characters and the white space between them
        words = F.size(F.split(F.btrim("line", F.lit(BLANK)), f"[{BLANK}]+"))
        there = F.when(F.length("line") >= 2 * min_words - 1, words >= min_words).otherwise(False)
    return lines.filter(there).select("doc", "site", _hash(F.col("line")).alias("key"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """``key, first, n``: lines on ``min_sites`` distinct sites or more, first document, occurrences; stored."""
    error = 3 * 1.04 / 2 ** (lg_k / 2)  # three standard errors of the sketch
    low, high = min(min_sites - 1, min_sites * (1 - error)), max(min_sites + 1, min_sites * (1 + error))
    sketched = lines.groupBy("key").agg(
        F.hll_sketch_agg("site", F.lit(lg_k)).alias("sites"), F.min("doc").alias("first"), F.count("*").alias("n")
    )
    spread = store(
        sketched.filter(F.col("n") >= min_sites)
        .select("key", "first", "n", F.hll_sketch_estimate("sites").alias("sites"))
        .filter(F.col("sites") >= low),
        "line-spread",
    )
    clear = spread.filter(F.col("sites") > high).select("key", "first", "n")
    near = spread.filter(F.col("sites") <= high).select("key", "first", "n")
    exact = (
        spread_join(lines, near, "key", "n", "doc").groupBy("key", "site").agg(F.first("first").alias("first"), F.first("n").alias("n"))
        .groupBy("key").agg(F.first("first").alias("first"), F.first("n").alias("n"), F.count("*").alias("sites"))
        .filter(F.col("sites") >= min_sites).select("key", "first", "n")
    )
    return store(clear.unionByName(exact), "boilerplate")


def repeated(lines: DataFrame) -> DataFrame:
    """``key, first, n``: lines in two documents or more, counted exactly; stored."""
    counted = lines.groupBy("key").agg(
        F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("doc").alias("named"), F.count("*").alias("n")
    )
    several = (F.col("first") != F.col("last")) | ((F.col("named") > 0) & (F.col("named") < F.col("n")))
    return store(counted.filter(several).select("key", "first", "n"), "repeated")


def drops(lines: DataFrame, removed: DataFrame) -> DataFrame:
    """``_doc, _drop``: hashes of the lines each document loses, stored.

    The hashes are dealt into about as many buckets as their square root, so that looking every line of a
    very long text up stays cheap.
    """
    lost = (
        spread_join(lines, removed, "key", "n", "doc").filter(~F.col("doc").eqNullSafe(F.col("first")))
        .groupBy("doc").agg(F.collect_set("key").alias("keys"))
    )
    count = F.ceil(F.sqrt(F.size("keys"))).cast("int")
    dealt = F.transform(
        F.sequence(F.lit(0), count - 1), lambda b: F.filter("keys", lambda k: F.pmod(k, count.cast("long")) == b.cast("long"))
    )
    return store(lost.select(F.col("doc").alias("_doc"), dealt.alias("_drop")), "line-drops")


def dedup(docs: DataFrame, min_sites: int = MIN_SITES, counter: str = "n_removed") -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and ``counter``, the lines taken."""
    lines = occurrences(docs)
    return _without(docs, drops(lines, boilerplate(lines, min_sites)), counter)


def without_passages(docs: DataFrame, min_words: int = PASSAGE_WORDS, counter: str = "n_removed") -> DataFrame:
    """``docs`` with long lines left in their first document only, and ``counter``, the lines taken."""
    lines = occurrences(docs, min_words)
    return _without(docs, drops(lines, repeated(lines)), counter)


def _without(docs: DataFrame, lost: DataFrame, counter: str) -> DataFrame:
    keys = lost.agg(F.sum(F.aggregate("_drop", F.lit(0), lambda n, b: n + F.size(b)))).first()[0] or 0
    key, drop, kept = (free(name, docs) for name in ("_doc", "_drop", "_left"))
    lost = lost.select(F.col("_doc").alias(key), F.col("_drop").alias(drop))
    hinted = F.broadcast(lost) if keys <= SMALL_DROPS else lost.hint("shuffle_hash")
    joined = docs.join(hinted, F.col("doc_id").eqNullSafe(F.col(key)), "left")
    parts = F.split("text", "\n")

    def stays(line: Column) -> Column:
        # Blank lines hash to the hash of the empty text, which is never a key.
        bucket = F.pmod(_hash(line), F.size(drop).cast("long")).cast("int")
        return ~F.array_contains(F.get(drop, bucket), _hash(line))

    touched = F.col(drop).isNotNull() & F.col("text").isNotNull()
    left = F.when(touched, F.filter(parts, stays))
    # Kept lines are counted by their separators, so the filter runs once.
    cleaned = joined.withColumn(kept, left)
    count = F.when(F.col(kept).isNull(), 0).otherwise(F.size(parts) - F.size(kept)).cast("long")
    text = F.when(F.col(kept).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return cleaned.select(*(text.alias("text") if c == "text" else F.col(c) for c in docs.columns if c != counter), count.alias(counter))


SQL = f"""
WITH lines AS (
  SELECT doc_id, coalesce('s' || source, '') AS site, trim(line, e' \\t\\n\\x0b\\x0c\\r') AS k
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents)
),
boilerplate AS (
  SELECT k, min(doc_id) AS first_doc FROM lines WHERE k <> '' GROUP BY k HAVING count(DISTINCT site) >= {MIN_SITES}
),
judged AS (
  SELECT d.doc_id, d.pos, d.line, b.k IS NOT NULL AND b.first_doc IS DISTINCT FROM d.doc_id AS gone
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM documents) d
  LEFT JOIN boilerplate b ON b.k = trim(d.line, e' \\t\\n\\x0b\\x0c\\r')
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
       count(*) FILTER (WHERE gone) AS n_removed
FROM judged GROUP BY doc_id
"""


def report(docs: DataFrame) -> DataFrame:
    return dedup(docs.select("doc_id", "source", "text")).select("doc_id", "text", "n_removed")
