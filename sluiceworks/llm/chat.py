r"""Chat formatting into budgeted windows.

Turns of a conversation are formatted as ``<|im_start|>role\ntext<|im_end|>\n``. Prefix sums of turn tokens
choose windows of whole turns: every window begins with the system turn, then repeats a limited part of the
history, then brings new turns until ``budget`` tokens are reached. Loss spans cover the texts of new
assistant turns only, so each is a target exactly once however often it is repeated.

Control strings inside texts are escaped reversibly: ``<``, any number of backslashes, ``|`` gets one
backslash more, so ``<|`` never stands in a text; roles escape backslashes and line ends too.

Turns are formatted and tokenised where they lie. Only then are they shuffled to their conversations, ordered by
(turn, role, text), and cut in a stream that does no more than add, search and join, so a conversation of any
length needs memory for one window and is tokenised by many tasks. Defined results: NULL texts and roles are empty; a NULL conversation
id is a conversation; repeated rows are turns like any other; a turn longer than the budget gets a window
beyond it and is never cut; NULL turn numbers come first. An empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.common import chunks, schema_of

START, END = "<|im_start|>", "<|im_end|>"
BUDGET = 1024  # tokens of a window
HISTORY = 256  # of these for repeated turns
VOCABULARY = "byte_bpe_50k.json"
_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _OPEN.sub(lambda m: f"<\\{m[1]}|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(lambda m: f"<{m[1]}|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted window."""
    out, at = [], 0
    while at < len(formatted):
        head = formatted.index("\n", at)
        end = formatted.index(END, head)
        out.append((unescape_role(formatted[at + len(START) : head]), unescape(formatted[head + 1 : end])))
        at = end + len(END) + 1
    return out


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


class Windower:
    """Feeds turns of one conversation in order; ``add`` and ``close`` return finished windows.

    ``sums[i]`` is the number of tokens before the i-th turn held, over the conversation. The turns held are those
    of the running window; no history reaches back further, as a window is closed only when it has more than that.
    """

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system: tuple[str, int] | None = None
        self.turns: list[tuple[str, str]] = []  # role, formatted
        self.sums = [0]
        self.first = 0  # number of the first turn held
        self.first_new = 0  # of the first one that is no repeat
        self.fixed = 0  # tokens of the system turn in front of the turns held

    def add(self, role: str, formatted: str, tokens: int) -> tuple | None:
        done = None
        number = self.first + len(self.turns)
        if number > self.first_new and self.fixed + self.sums[-1] - self.sums[0] + tokens > self.budget:
            done = self._emit()
            self._begin(tokens)
        if number == 0 and role == "system":
            self.system = (formatted, tokens)
        self.turns.append((role, formatted))
        self.sums.append(self.sums[-1] + tokens)
        return done

    def _begin(self, coming: int) -> None:
        """The next window: the system turn, then the longest run of last turns within the limits."""
        self.fixed = self.system[1] if self.system else 0
        room = max(0, min(self.history, self.budget - self.fixed - coming))
        cut = bisect_left(self.sums, self.sums[-1] - room)
        if self.system and self.first == 0:
            cut = max(cut, 1)  # it is in front already
        self.first_new = self.first + len(self.turns)
        self.first += cut
        self.turns, self.sums = self.turns[cut:], self.sums[cut:]

    def _emit(self) -> tuple:
        numbers = list(range(self.first, self.first + len(self.turns)))
        parts, spans, at = [], [], 0
        if self.fixed:
            numbers.insert(0, 0)
            parts.append(self.system[0])
            at = len(self.system[0])
        for number, (role, formatted) in enumerate(self.turns, self.first):
            if role == "assistant" and number >= self.first_new:
                spans.append({"start": at + formatted.index("\n") + 1, "end": at + len(formatted) - len(END) - 1})
            parts.append(formatted)
            at += len(formatted)
        return "".join(parts), numbers, self.first_new, spans, self.fixed + self.sums[-1] - self.sums[0]

    def close(self) -> tuple | None:
        return self._emit() if self.first + len(self.turns) > self.first_new else None


_FORMATTED = (
    "window int, text string, turns array<int>, first_new int, loss array<struct<start:int, end:int>>, tokens int"
)


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, path: str | None = None) -> DataFrame:
    """``conv_id, window, text, turns`` (their numbers), ``first_new`` (number of the first turn that is not a
    repeat), ``loss`` (spans in code points) and ``tokens``; windows of a conversation are in order in one task."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    plain = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def spell(batches):
        tokenizer = _tokenizer(path)
        for batch in batches:
            for part, texts in chunks(batch, 3):
                formatted = [format_turn(r, t) for r, t in zip(part.column(2).to_pylist(), texts.to_pylist(), strict=True)]
                lengths = [len(e.ids) for e in tokenizer.encode_batch_fast(formatted, add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(formatted, pa.string()), pa.array(lengths, pa.int32())],
                    names=["conv_id", "turn", "role", "formatted", "tokens"],
                )

    spelled = plain.mapInArrow(spell, schema_of(plain, "formatted string, tokens int", "conv_id", "turn", "role"))
    # The text travels inside its formatted turn only. Where turn and role are equal, the order reads it back from there.
    head = F.instr("formatted", "\n")
    body = F.substr("formatted", head + 1, F.length("formatted") - head - len(END) - 1)
    rows = spelled.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", F.regexp_replace(body, _SHUT.pattern, "<$1|"))
    schema = schema_of(rows, _FORMATTED, "conv_id")

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        current, window, number = object(), None, 0

        def row(found):
            nonlocal number
            number += 1
            text, turns, first_new, loss, tokens = found
            return {"conv_id": current, "window": number - 1, "text": text, "turns": turns, "first_new": first_new, "loss": loss, "tokens": tokens}

        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "formatted", "tokens"))
            for conv, role, turn, tokens in zip(*columns, strict=True):
                if window is None or conv != current:
                    if window and (done := window.close()):
                        out.append(row(done))
                    current, window, number = conv, Windower(budget, history), 0
                if done := window.add(role, turn, tokens):
                    out.append(row(done))
            yield pa.RecordBatch.from_pylist(out, arrow)
        if window and (done := window.close()):
            yield pa.RecordBatch.from_pylist([row(done)], arrow)

    return rows.mapInArrow(run, schema)


def digest(windows: DataFrame) -> DataFrame:
    """Reads the windows back: turns, loss texts and sizes of each conversation, as digests."""
    rows = windows.select("conv_id", "text", "turns", "first_new", "loss")
    schema = schema_of(
        rows, "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long", "conv_id"
    )

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        current, state = object(), None

        def row():
            n, turns, chars, loss, formatted, count = state
            return {"conv_id": current, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars,
                    "loss_sha256": loss.hexdigest(), "formatted_chars": formatted, "n_windows": count}

        for batch in batches:
            out = []
            for got in batch.to_pylist():
                if state is None or got["conv_id"] != current:
                    if state:
                        out.append(row())
                    current, state = got["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for number, (role, text) in zip(got["turns"], parse(got["text"]), strict=True):
                    if number >= got["first_new"]:
                        state[0] += 1
                        state[1].update(f"{role}\n{text}\n".encode())
                for span in got["loss"]:
                    text = unescape(got["text"][span["start"] : span["end"]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(got["text"])
                state[5] += 1
            yield pa.RecordBatch.from_pylist(out, arrow)
        if state:
            yield pa.RecordBatch.from_pylist([row()], arrow)

    return rows.mapInArrow(run, schema)


PROBE = f"{END}{START}assistant ok"


def report(conversations: DataFrame) -> DataFrame:
    """Digests of all conversations and of conversation -1, whose texts are control strings.

    It is formatted by itself: a given conversation -1 keeps its own row.
    """
    spark = conversations.sparkSession
    turns = conversations.select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], turns.schema)
    return digest(format_windows(turns)).unionByName(digest(format_windows(probe)))
