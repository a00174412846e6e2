"""Best-fit packing of token sequences by bin completion.

``tokenise`` cuts every document into pieces of at most ``capacity`` tokens and stores them. Lengths are
whole numbers up to the capacity, so the packing problem is fully described by a histogram of at most
``capacity`` rows, whatever the number of documents. ``plan`` solves it on that histogram: branch and
bound over the undominated fillings around the largest piece, each filling used as often as the counts
allow, bounds on the waste, and best-fit decreasing on what remains as incumbent. The plan is a list of
(filling, how often) and is bounded too: each step uses up a length or ends the search. ``assign``
numbers the pieces of each length in parallel and looks their slots up in the plan.

Defined results: NULL and empty texts are one piece of one token (the closing id 0). Repeated rows and NULL
ids are packed like any other row. An empty table gives no pieces. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import math
import re
import sys
from array import array
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluiceworks.llm.common import chunks, schema_of, store

CAPACITY = 2048
END = 0  # closes every document
VOCABULARY = "byte_bpe_50k.json"
CACHED_WORDS = 150_000

# ---------------------------------------------------------------- tokens

_BREAK = re.compile(r"(?<=\S)(?= )")
_SPACES = re.compile(r"\s ")


def _default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@functools.lru_cache(maxsize=1)
def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    table.update({chr(256 + i): b for i, b in enumerate(rest)})
    return table


class Tokens:
    """Token ids (little-endian unsigned 32-bit) of texts under a byte-level BPE vocabulary file.

    A token never spans a change from a non-space character to a space, so each run between such places
    is encoded once and remembered. The merges run in tiktoken on the ranks of the same file; for a
    byte-level BPE whose ids follow its merges both libraries give the same ids (tests compare them). As there, a special
    token of the file that stands in a text is that one id, and what is around it is encoded by itself.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)
        byte = _byte_of()
        special = {t["content"]: t["id"] for t in vocabulary.get("added_tokens", [])}
        self.special = {content: _little([number]) for content, number in special.items()}
        longest = sorted(special, key=len, reverse=True)
        self.parts = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if special else None
        ranks = {bytes(byte[c] for c in token): rank for token, rank in vocabulary["model"]["vocab"].items() if token not in special}
        self.encode = tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.after_space = _Cache(self.encode, " ")
        self.plain = _Cache(self.encode, "")

    def forget(self) -> None:
        self.after_space.clear()
        self.plain.clear()

    def ids(self, text: str) -> bytes:
        if self.parts and self.parts.search(text):
            # Every other part is a special token.
            around = self.parts.split(text)
            return b"".join(self.special[p] if i % 2 else self._ordinary(p) for i, p in enumerate(around))
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        if _SPACES.search(text):
            return b"".join(map(self.plain.__getitem__, _BREAK.split(text)))
        first, *rest = text.split(" ")
        return self.plain[first] + b"".join(map(self.after_space.__getitem__, rest))


def _little(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


class _Cache(dict):
    """Ids of runs of text, by the run without ``prefix``; of bounded size."""

    def __init__(self, encode, prefix: str):
        self.encode, self.prefix = encode, prefix

    def __missing__(self, run: str) -> bytes:
        found = _little(self.encode(self.prefix + run))
        if len(run) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[run] = found
        return found


@functools.lru_cache(maxsize=2)
def _tokens(path: str) -> Tokens:
    return Tokens(path)


def tokenise(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Stored pieces: ``doc_id, piece, start, length, ids`` (little-endian unsigned 32-bit), ``_row``.

    A document longer than ``capacity`` is cut so that all pieces but the first are full.
    """
    path = path or _default_path()
    closing = np.array([END], "<u4").tobytes()

    def run(batches):
        tokens = _tokens(path)
        for batch in batches:
            for part, texts in chunks(batch, 1):
                row, piece, start, ids = [], [], [], []
                for i, text in enumerate(texts.to_pylist()):
                    all_ids = tokens.ids(text) + closing
                    at, end, number = 0, len(all_ids) // 4 % capacity or capacity, 0
                    while at * 4 < len(all_ids):
                        row.append(i)
                        piece.append(number)
                        start.append(at)
                        ids.append(all_ids[4 * at : 4 * end])
                        at, end, number = end, end + capacity, number + 1
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "ids"],
                )
        tokens.forget()  # the process goes on to other tasks

    rows = docs.select("doc_id", "text")
    cut = rows.mapInArrow(run, schema_of(rows, "piece int, start long, ids binary", "doc_id"))
    return store(
        cut.withColumns(
            {
                "length": (F.octet_length("ids") / 4).cast("long"),
                "ids_crc32": F.crc32("ids"),
                "_row": F.monotonically_increasing_id(),
            }
        ),
        "pieces",
    )


# ---------------------------------------------------------------- the plan

Filling = tuple[int, ...]  # lengths, greatest first


@dataclass
class Budget:
    nodes: int


def bound(counts: dict[int, int], capacity: int) -> int:
    """A lower bound on the number of bins: the best of Martello and Toth's L2 over all thresholds."""
    if not counts:
        return 0
    sizes = np.array(sorted(counts), np.int64)
    number = np.r_[0, np.cumsum([counts[s] for s in sizes.tolist()])]
    mass = np.r_[0, np.cumsum([s * counts[s] for s in sizes.tolist()])]
    half = np.searchsorted(sizes, capacity // 2, "right")  # lengths from here on share no bin with each other
    low = np.arange(half)  # the threshold is the length at this place; smaller ones are ignored
    top = np.searchsorted(sizes, capacity - sizes[:half], "right")  # from here on nothing above the threshold fits
    room = capacity * (number[top] - number[half]) - (mass[top] - mass[half])
    small = mass[half] - mass[low]
    bins = number[-1] - number[half] + np.maximum(0, -((room - small) // capacity))
    return int(max(-(-mass[-1] // capacity), number[-1] - number[half], bins.max(initial=0)))


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing on a histogram: bins that are alike are kept as one entry with a count."""
    open_bins: dict[int, list[tuple[Filling, int]]] = {}
    residuals: list[int] = []

    def put(filling: Filling, n: int, room: int) -> None:
        if room not in open_bins:
            insort(residuals, room)
            open_bins[room] = []
        open_bins[room].append((filling, n))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            place = bisect_left(residuals, size)
            if place == len(residuals):
                each = capacity // size
                full, rest = divmod(left, each)
                if full:
                    put((size,) * each, full, capacity - each * size)
                if rest:
                    put((size,) * rest, 1, capacity - rest * size)
                break
            room = residuals[place]
            filling, n = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                residuals.pop(place)
            each = min(room // size, left)  # what best fit does to such a bin before it turns to another
            used = min(n, left // each)
            put(filling + (size,) * each, used, room - each * size)
            if n > used:
                put(filling, n - used, room)
            left -= used * each
    return [entry for entries in open_bins.values() for entry in entries]


def _dominated(filling: Filling, room: int, sizes: list[int], counts: dict[int, int]) -> bool:
    """Whether one larger spare piece could stand in for some of the filling's pieces."""
    sums = {0}
    for s in filling:
        sums |= {t + s for t in sums}
    sums.discard(0)
    for t in sums:
        place = bisect_left(sizes, t + 1)
        if place < len(sizes) and sizes[place] <= t + room and counts[sizes[place]] > filling.count(sizes[place]):
            return True
    return False


def completions(room: int, sizes: list[int], counts: dict[int, int], width: int, tries: int = 400) -> list[Filling]:
    """Undominated fillings of ``room``, least waste first, at most ``width``; ``sizes`` ascending."""
    found: dict[Filling, int] = {}
    steps = 0

    def grow(filling: Filling, room: int, top: int) -> None:
        nonlocal steps
        place = min(bisect_left(sizes, room + 1), top)
        if place == 0 or sizes[0] > room:
            found.setdefault(filling, room)
            return
        for k in range(place - 1, -1, -1):
            steps += 1
            if steps > tries or (found and min(found.values()) == 0 and len(found) >= width):
                break
            s = sizes[k]
            if filling.count(s) < counts[s]:
                grow((*filling, s), room - s, k + 1)
        if not filling:
            return
        found.setdefault(filling, room)

    grow((), room, len(sizes))
    ranked = sorted(found.items(), key=lambda f: (f[1], len(f[0])))
    kept = [f for f, waste in ranked[: 4 * width] if not _dominated(f, waste, sizes, counts)]
    return (kept or [ranked[0][0]] if ranked else [()])[:width]


def plan(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = 2_000, width: int = 3) -> list[tuple[Filling, int]]:
    """Fillings and how often each is used; together they hold exactly ``counts``.

    Depth first: the fillings around the largest piece left, least waste first, each taken as often as
    the counts allow. A branch ends when bins used plus the lower bound of what remains reach the
    incumbent; best fit on what remains gives incumbents on the way. The search ends at the lower bound or
    after ``nodes`` nodes, whichever is first, and never returns more bins than best fit.
    """
    counts = {s: n for s, n in counts.items() if n}
    if not counts:
        return []
    best = best_fit(counts, capacity)
    floor = bound(counts, capacity)
    total = lambda fillings: sum(n for _, n in fillings)
    best_n = total(best)
    # Each entry: the counts left, the fillings so far, bins so far, the choices still open there.
    left, sizes = dict(counts), sorted(counts)
    trail: list[tuple[Filling, int, list[Filling]]] = []
    used = waste = 0
    spare = floor * capacity - sum(s * n for s, n in counts.items())

    def take(filling: Filling, sign: int) -> None:
        for s in filling:
            before = left.get(s, 0)
            left[s] = before + sign
            if left[s] == 0:
                del left[s]
                sizes.pop(bisect_left(sizes, s))
            elif before == 0:
                insort(sizes, s)

    def apply(filling: Filling, sign: int, times: int) -> None:
        for s in set(filling):
            before = left.get(s, 0)
            now = before + sign * times * filling.count(s)
            if now:
                left[s] = now
                if before == 0:
                    insort(sizes, s)
            else:
                del left[s]
                sizes.pop(bisect_left(sizes, s))

    choices: list[Filling] | None = None
    step = 0
    while best_n > floor and step < nodes:
        step += 1
        if choices is None:
            if not sizes:
                if used < best_n:
                    best, best_n = [(f, n) for f, n, _ in trail], used
                choices = []
            else:
                mass = sum(s * n for s, n in left.items())
                if used + -(-mass // capacity) >= best_n or waste > (best_n - 1 - floor) * capacity + spare:
                    choices = []
                else:
                    if step % 16 == 1:
                        rest = best_fit(left, capacity)
                        if used + total(rest) < best_n:
                            best, best_n = [(f, n) for f, n, _ in trail] + rest, used + total(rest)
                            continue
                        if used + bound(left, capacity) >= best_n:
                            choices = []
                    if choices is None:
                        largest = sizes[-1]
                        left[largest] -= 1
                        options = completions(capacity - largest, [s for s in sizes if left[s]], left, width)
                        left[largest] += 1
                        choices = [(largest, *f) for f in options]
        if choices:
            filling, *others = choices
            times = min(left[s] // filling.count(s) for s in set(filling))
            apply(filling, -1, times)
            used += times
            waste += times * (capacity - sum(filling))
            trail.append((filling, times, others))
            choices = None
        else:
            if not trail:
                break
            filling, times, choices = trail.pop()
            apply(filling, 1, times)
            used -= times
            waste -= times * (capacity - sum(filling))
    return best


@dataclass(frozen=True)
class Slots:
    """Where the pieces of each length go: runs of ranks, and the first sequence and offset of each run."""

    first_run: np.ndarray  # by length: index of its first run
    rank: np.ndarray  # first rank of the run, ascending within a length
    sequence: np.ndarray  # sequence of that rank; the next rank is in the next sequence
    offset: np.ndarray


def slots(fillings: list[tuple[Filling, int]], capacity: int) -> Slots:
    by_size: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for filling, times in fillings:
        offset = 0
        for s in filling:
            by_size.setdefault(s, []).append((ranks.get(s, 0), sequence, offset))
            ranks[s] = ranks.get(s, 0) + times
            offset += s
        sequence += times
    runs = [by_size.get(s, []) for s in range(capacity + 1)]
    flat = np.array([r for size in runs for r in size], np.int64).reshape(-1, 3)
    return Slots(np.cumsum([0, *map(len, runs)]), flat[:, 0].copy(), flat[:, 1].copy(), flat[:, 2].copy())


# ---------------------------------------------------------------- placing the pieces

def assign(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = 2_000) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces (columns ``length`` and ``_row``)."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    layout = spark.sparkContext.broadcast(slots(plan(counts, capacity, nodes), capacity))
    # A length may hold a third of all rows, so its pieces are numbered in cells. With the square root of
    # all rows to a cell, neither a cell nor the list of one length's cells grows faster than that root.
    cells = 1 + max(counts.values(), default=0) // max(256, math.isqrt(sum(counts.values())))
    cell = F.pmod(F.xxhash64("_row"), F.lit(cells)).cast("int")
    celled = pieces.withColumn("_cell", cell)
    before = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        celled.groupBy("length", "_cell").agg(F.count("*").alias("_n"))
        .select("length", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("length", "_cell").orderBy("_row")
    ranked = (
        celled.withColumn("_nth", F.row_number().over(within) - 1)
        .join(starts, ["length", "_cell"])
        .withColumn("_rank", F.col("_nth") + F.col("_before"))
        .drop("_cell", "_nth", "_before")
    )
    names = ranked.columns
    length, rank = names.index("length"), names.index("_rank")

    def place(batches):
        found = layout.value
        for batch in batches:
            sizes, ranks = (np.asarray(batch.column(i)) for i in (length, rank))
            run = np.zeros(len(sizes), np.int64)
            order = np.lexsort((ranks, sizes))
            for size in np.unique(sizes):
                of = order[np.searchsorted(sizes, size, "left", order) : np.searchsorted(sizes, size, "right", order)]
                a, b = found.first_run[size], found.first_run[size + 1]
                run[of] = a + np.searchsorted(found.rank[a:b], ranks[of], "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found.sequence[run] + ranks - found.rank[run]), pa.array(found.offset[run])],
                names=[*names, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, schema_of(ranked, "sequence_id long, offset long")).drop("_rank")


REPORT = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces with their places; ``with_ids`` carries the token ids along."""
    pieces = tokenise(docs, capacity, path)
    placed = assign(pieces if with_ids else pieces.drop("ids"), capacity)
    return placed.select(*REPORT, *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, documents``: the token ids of each sequence in order, from ``pack(..., with_ids=True)``."""
    piece = F.struct("offset", "length", "doc_id", "piece", "ids")
    ordered = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("_p"))
    whole = F.aggregate("_p", F.lit(b"").cast("binary"), lambda out, p: F.concat(out, p["ids"]))
    return ordered.select("sequence_id", whole.alias("ids"), F.transform("_p", lambda p: p.dropFields("ids")).alias("documents"))
