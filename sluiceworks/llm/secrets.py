r"""Secret scans: fixed patterns, and a battery of randomness tests for everything else.

The base patterns (``assign``, ``access``, ``hex``) are matched leftmost, non-overlapping, per kind. Other
candidates are all runs of at least ``MIN_LENGTH`` characters of the base64 alphabets. For each the encoding is
inferred (digits, letters, hexadecimal, base32, alphanumeric, base64: the smallest alphabet that holds it), and three tests ask whether it could be a uniform random
string in that encoding: chi-squared of the alphabet, Wald-Wolfowitz runs round the median symbol, serial
correlation of neighbours. Their p-values are combined by Cauchy's method. Ordinary strings fail the tests; which failures
count is decided over all candidates at once by Benjamini and Hochberg's rule in each class of content (digits, no
digits, both) and length, so that of the strings called ordinary at most a share ``RATE`` is expected to be random. What
is left is random: kind ``random``. The rule needs only counts per (class, p-value bucket), which partial aggregation adds up.

Spans are in code points, end exclusive. Defined results: NULL and empty texts have no spans. Repeated rows
are scanned one by one. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.common import chunks, schema_of, store

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
# A run that is too short holds no longer match, so the least lengths can stand in these two patterns.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
MIN_LENGTH = 20

RATE = 0.1
BUCKET = 0.05  # width of a p-value bucket, in powers of ten
LENGTHS = (20, 24, 32, 48, 64, 128)  # lower ends of the length classes

_ALPHABETS = {
    "digits": string.digits,
    "lower": string.ascii_lowercase,
    "upper": string.ascii_uppercase,
    "letters": string.ascii_uppercase + string.ascii_lowercase,
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": string.ascii_uppercase + "234567",
    "lower36": string.digits + string.ascii_lowercase,
    "upper36": string.digits + string.ascii_uppercase,
    "base62": string.digits + string.ascii_uppercase + string.ascii_lowercase,
    "base64": string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/",
    "base64url": string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_",
}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``kind, start, end`` of the base patterns, by start, then kind as listed."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def infer(token: str) -> str | None:
    """The smallest alphabet that holds the token; None if no alphabet has all its signs."""
    used = set(token)
    return next((name for name, alphabet in _ALPHABETS.items() if used <= set(alphabet)), None)


def _upper_normal(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _upper_chi(x: float, free: int) -> float:
    """Upper tail of chi-squared with up to three degrees of freedom."""
    if free == 0:
        return 1.0
    root = math.erfc(math.sqrt(x / 2))
    return {1: root, 2: math.exp(-x / 2), 3: root + math.sqrt(2 * x / math.pi) * math.exp(-x / 2)}[free]


def _class(c: str, spoken: bool) -> str:
    """Digits, capitals, small letters and signs; in alphabets of letters alone, vowels apart, as words are rich in them."""
    kind = "digit" if c.isdigit() else "capital" if c.isupper() else "small" if c.islower() else "sign"
    return f"{kind} vowel" if spoken and c in "aeiouAEIOU" else kind


def _content(token: str) -> int:
    """Class of content: 0 digits and letters, 1 without a digit, 2 without a letter."""
    return 1 if not any(c.isdigit() for c in token) else 0 if any(c.isalpha() for c in token) else 2


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(token: str) -> tuple[str, float] | None:
    """Encoding and combined p-value under 'uniform random in that encoding'; None if it is no candidate."""
    token = token.rstrip("=")
    name = infer(token)
    if name is None or len(token) < MIN_LENGTH:
        return None
    alphabet = _ALPHABETS[name]
    place = {c: i for i, c in enumerate(alphabet)}
    n, k = len(token), len(alphabet)
    # Chi-squared over the alphabet; with few characters per symbol its mean is k - 1 and its variance
    # 2 (k - 1) (n - 1) / n exactly, and the cube root is close to normal.
    chi = sum(c * c for c in Counter(token).values()) * k / n - n
    free = k - 1
    spread = 2 / (9 * free) * (n - 1) / n
    uniform = _upper_normal(((max(chi, 0) / free) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))
    # The same for digits, capitals, small letters and signs, which short strings fill better than symbols.
    spoken = alphabet.isalpha()
    wanted = Counter(_class(c, spoken) for c in alphabet)
    got = Counter(_class(c, spoken) for c in token)
    coarse = sum((got[c] - n * w / k) ** 2 / (n * w / k) for c, w in wanted.items())
    uniform = min(1.0, 2 * min(uniform, _upper_chi(coarse, len(wanted) - 1)))
    values = np.array([place[c] for c in token], float)
    # Classes of characters alternate in random strings; words and counters keep to one.
    above = values >= k / 2
    n1, n0 = int(above.sum()), int(n - above.sum())
    if n1 and n0:
        runs = 1 + int((above[1:] != above[:-1]).sum())
        mean = 1 + 2 * n1 * n0 / n
        variance = (mean - 1) * (mean - 2) / (n - 1)
        alternating = _two_sided((runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0
    else:
        alternating = 2.0 ** (1 - n)
    centred = values - values.mean()
    energy = float((centred**2).sum())
    serial = _two_sided(float((centred[1:] * centred[:-1]).sum()) / energy * math.sqrt(n)) if energy else 0.0
    # Cauchy's combination: right whether or not the tests depend on each other, and not diluted by those that pass.
    mean = sum(math.tan((0.5 - min(max(p, 1e-15), 0.99)) * math.pi) for p in (uniform, alternating, serial)) / 3
    return name, (0.5 - math.atan(mean) / math.pi) if mean < 1e6 else 1 / (mean * math.pi)


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, int, int]]:
    """``start, end, class of content and length, p bucket`` of strings to test that no base span covers."""
    out = []
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        if any(s < end and start < e for _, s, e in base):
            continue
        tested = battery(m[0])
        if tested:
            size = max(i for i, low in enumerate(LENGTHS) if len(m[0]) >= low) + len(LENGTHS) * _content(m[0])
            out.append((start, end, size, int(-math.log10(max(tested[1], 1e-300)) / BUCKET)))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """Stored: doc_id, ``base`` spans and ``tested`` strings with class and p-value bucket."""
    rows = docs.select("doc_id", "text")
    span = "struct<kind:string, start:int, end:int>"
    schema = schema_of(rows, f"base array<{span}>, tested array<struct<start:int, end:int, size:int, bucket:int>>", "doc_id")

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(schema)
        for batch in batches:
            for part, texts in chunks(batch, 1):
                base, tested = [], []
                for text in texts.to_pylist():
                    spans = base_spans(text)
                    base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans])
                    tested.append([dict(zip(("start", "end", "size", "bucket"), c, strict=True)) for c in candidates(text, spans)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(base, types.field("base").type), pa.array(tested, types.field("tested").type)], schema=types
                )

    return store(rows.mapInArrow(run, schema), "secrets")


def cutoffs(scanned: DataFrame, rate: float = RATE) -> dict[int, int]:
    """Per class of content and length, the p-value bucket from which on strings are called ordinary.

    Benjamini and Hochberg: the greatest p with p <= rate * rank / m, read off the bucket counts with the
    greatest p of each bucket. At most classes x 6,000 rows reach the driver.
    """
    counts = scanned.select(F.explode("tested").alias("t")).groupBy("t.size", "t.bucket").agg(F.count("*").alias("n")).collect()
    out = {}
    for size in {r["size"] for r in counts}:
        own = sorted(((r["bucket"], r["n"]) for r in counts if r["size"] == size), reverse=True)
        total, rank, limit = sum(n for _, n in own), 0, 1 << 30
        for bucket, n in own:  # from the smallest p up
            rank += n
            if 10 ** (-bucket * BUCKET) <= rate * rank / total:
                limit = bucket
        out[size] = limit
    return out


def find(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, ``base`` spans and all ``spans`` in order."""
    scanned = scan(docs)
    limits = cutoffs(scanned, rate)
    def random_of(t):
        edge = F.lit(1 << 30)
        for size, bucket in limits.items():
            edge = F.when(t["size"] == size, F.lit(bucket)).otherwise(edge)
        return t["bucket"] < edge

    def placed(span, kind):
        return F.struct(span["start"].alias("start"), kind.alias("order"), span["end"].alias("end"))

    order = F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)))
    every = F.concat(
        F.transform("base", lambda s: placed(s, order[s["kind"]])),
        F.transform(F.filter("tested", random_of), lambda s: placed(s, F.lit(KINDS.index("random")))),
    )
    names = F.array(*map(F.lit, KINDS))
    return scanned.select(
        "doc_id", "base",
        F.transform(F.sort_array(every), lambda s: F.struct(F.get(names, s["order"]).alias("kind"), s["start"], s["end"])).alias("spans"),
    )


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    found = find(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def sha256_of(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
