"""Secrets in texts: fixed patterns, and values of credential fields that are hard to guess.

The cost of guessing a value is the cheapest way to cut it into dictionary
words, dates, repeats, keyboard walks and brute-force spans, found by dynamic
programming over its positions, with every part of a walk or a repeat as a segment. Work per value is linear in its length.
Words are ranked by how often the corpus has them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import mapped, stored

# The three patterns and the least length of what they must find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so the least length can stand in the pattern

# Fields whose value is judged by its cost: more names, and any value: from a quote to the next of its kind on the
# line that no backslash precedes, or else without blanks, quotes and , ; < > ( ) { }. A quote before a blank opens none.
FIELD = re.compile(
    r"""(?:passwords?|passwd|passphrase|pwd|secret|token|api[_-]?key|private[_-]?key|access[_-]?key|credentials?|auth)"""
    r"""["']?[\x20\t]*(?::=|=>|[:=])[\x20\t]*(?:(["'`])(?!\x20|\t)((?:\\[^\r\n]|(?!\1)[^\\\r\n])++)\1|["'`]?([^\s"'`,;<>(){}]+))""",
    re.IGNORECASE | re.ASCII,
)
BEARER = re.compile(r"\bbearer[\x20\t]+([A-Za-z0-9+/_.=~-]+)", re.IGNORECASE | re.ASCII)
HINTS = ("passw", "passphrase", "pwd", "secret", "token", "api", "key", "credential", "auth", "bearer")
BASE_HINTS = ("passw", "secret", "token", "api")

# Frequent passwords and their parts, most frequent first.
WORDS = (
    "password admin welcome login letmein qwerty master dragon monkey shadow sunshine princess football baseball "
    "superman batman trustno iloveyou hello freedom whatever starwars computer internet michael jordan hunter "
    "charlie andrew thomas daniel jessica jennifer ashley nicole summer winter spring autumn monday tuesday "
    "wednesday thursday friday saturday sunday january february march april june july august september october "
    "november december secret token key user root guest test demo default changeme example sample temp server "
    "system service database access public private api auth pass word love money power magic orange purple "
    "yellow silver golden black white green blue red cookie pepper ginger cheese banana apple tiger lion eagle "
    "falcon phoenix thunder matrix london paris berlin dallas chicago boston secure safe open close your the "
    "and my new old none null true false undefined placeholder here enter insert value"
).split()
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
LEET = str.maketrans("013457@$!", "oieastasi")


@dataclass(frozen=True)
class GuessModel:
    """What a guesser is taken to know, as decimal logarithms of the number of guesses.

    ``words`` are in the order they are tried; ``learnt_model`` adds up to ``learnt`` of a corpus.
    """

    words: tuple[str, ...] = tuple(WORDS)
    learnt: int = 20_000
    min_log10: float = 8.0
    min_length: int = 6
    per_segment: float = math.log10(2)  # the guesser does not know where segments end


@cache
def _ranks(words: tuple[str, ...]) -> tuple[dict[str, float], int]:
    ranks = {word: math.log10(rank + 1) for rank, word in reversed(list(enumerate(words, 1)))}
    return ranks, max(map(len, ranks), default=0)


@cache
def _steps() -> dict[str, tuple[str, ...]]:
    """For a pair of neighbours on keyboard rows or in the alphabet, the rows and directions."""
    steps: dict[str, tuple[str, ...]] = {}
    for row in ROWS:
        for a, b in zip(row, row[1:], strict=False):
            steps[a + b] = (*steps.get(a + b, ()), f"{row[0]}+")
            steps[b + a] = (*steps.get(b + a, ()), f"{row[0]}-")
    return steps


WALK_LEAST, DATE_LENGTHS, UNITS, TIMES_LEAST = 3, range(4, 11), range(1, 5), 3
DATE = re.compile(
    r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d"
    r"|(?:19|20)\d\d",
    re.ASCII,
)


class LogMin:
    """The least of value + log10(j - i) over the (i, value) added so far, for a growing j.

    A later one with a larger value is better at first, and from some j on the earlier one is. On
    the stack the last is the best now, and each is overtaken by the one below it before that is by the next.
    """

    def __init__(self) -> None:
        self.stack: list[tuple[int, float, float]] = []  # i, value, the j at which the one below is better

    @staticmethod
    def overtaken(early: tuple[int, float, float], i: int, value: float) -> float:
        ratio = 10 ** min(value - early[1], 300)
        return (ratio * i - early[0]) / (ratio - 1) if ratio > 1 else math.inf

    def add(self, i: int, value: float) -> None:
        while self.stack and self.stack[-1][1] >= value:
            self.stack.pop()
        while len(self.stack) > 1 and self.overtaken(self.stack[-1], i, value) >= self.stack[-1][2]:
            self.stack.pop()
        self.stack.append((i, value, self.overtaken(self.stack[-1], i, value) if self.stack else math.inf))

    def least(self, j: int) -> float:
        while len(self.stack) > 1 and j >= self.stack[-1][2]:
            self.stack.pop()
        return self.stack[-1][1] + math.log10(j - self.stack[-1][0]) if self.stack else math.inf


def _brute(char: str) -> float:
    """A character of a brute-force span, by the alphabet it is from."""
    if char.isdigit():
        return 1.0
    if char.isascii() and char.isalpha():
        return math.log10(26)
    return math.log10(33) if char.isascii() else 2.0


def word_cost(value: str, lower: str, plain: str, rank: float) -> float:
    """A word of this rank, written with other letters or cases."""
    return rank + ((plain != lower) + (value != lower)) * math.log10(2)


def date_cost(length: int) -> float:
    return math.log10(366 * 100 if length > 4 else 100)


def guess_log10(value: str, model: GuessModel = GuessModel()) -> float:
    """The decimal logarithm of the guesses the cheapest segmentation needs; 0 for an empty value."""
    n = len(value)
    ranks, longest = _ranks(model.words)
    lower = value.lower() if len(value.lower()) == n else value
    plain = lower.translate(LEET)
    steps, brute = _steps(), [0.0, *map(_brute, value)]
    walks: dict[str, int] = {}  # by row and direction: letters of the walk that ends here
    same = dict.fromkeys(UNITS, 0)  # by length of the unit: letters in turn equal to those so far before
    repeats: dict[tuple[int, int], LogMin] = {}

    # spelled: the cheapest way that ends in a brute-force span; best[i]: any way to i.
    best, spelled = [0.0] * (n + 1), math.inf
    for end in range(1, n + 1):
        spelled = min(spelled, best[end - 1] + model.per_segment) + brute[end]
        found = math.inf
        for start in range(max(0, end - longest), end - 2):
            rank = ranks.get(plain[start:end])
            if rank is not None:
                found = min(found, best[start] + word_cost(value[start:end], lower[start:end], plain[start:end], rank))
        if value[end - 1] in "0123456789":
            for length in DATE_LENGTHS:
                if length <= end and DATE.fullmatch(value, end - length, end):
                    found = min(found, best[end - length] + date_cost(length))
        walks = {way: walks.get(way, 1) + 1 for way in steps.get(lower[end - 2 : end], ())} if end > 1 else {}
        for length in range(WALK_LEAST, max(walks.values(), default=0) + 1):
            found = min(found, best[end - length] + math.log10(40 * length))
        for unit in UNITS:
            same[unit] = same[unit] + 1 if end > unit and value[end - 1] == value[end - 1 - unit] else 0
            if same[unit] < unit * (TIMES_LEAST - 1):
                continue
            if same[unit] < unit * TIMES_LEAST:
                repeats[unit, end % unit] = LogMin()
            start = end - unit * TIMES_LEAST
            times = repeats[unit, end % unit]
            times.add(start // unit, best[start])
            found = min(found, times.least(end // unit) + sum(brute[end - unit + 1 : end + 1]))
        best[end] = min(spelled, found + model.per_segment)
    return best[n]


def learnt_model(docs: DataFrame, text_column: str = "text", model: GuessModel = GuessModel()) -> GuessModel:
    """The model with the words the corpus has most often, of 3 to 20 letters a to z, after those it has.

    All texts are counted. The driver gets up to ``learnt`` words: as many classes of about as frequent ones as that has room for.
    """
    pieces = F.filter(F.split(F.lower(F.col(text_column)), "[^a-z]++"), lambda word: F.length(word).between(3, 20))
    counts = docs.select(F.explode(pieces).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    known = docs.sparkSession.createDataFrame([(word,) for word in model.words] or [("",)], "word string")
    counts = counts.join(F.broadcast(known), "word", "left_anti").withColumn("class", F.floor(F.log2("n") * 64))
    counts, room, least = stored(counts, "words"), model.learnt, None
    for row in counts.groupBy("class").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("class")).collect():
        if row["words"] > room:
            break
        room, least = room - row["words"], row["class"]
    if least is None:
        return model
    learnt = counts.where(F.col("class") >= least).orderBy(F.desc("n"), "word").collect()
    return replace(model, words=(*model.words, *(row["word"] for row in learnt)))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The spans of the three patterns as start, rank of the kind, end."""
    spans = []
    low = text.lower()
    if any(hint in low for hint in BASE_HINTS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def guessed_spans(text: str, model: GuessModel) -> list[tuple[int, int, int, float]]:
    """The values of credential fields that cost enough to guess: start, rank of the kind, end, cost."""
    low = text.lower()
    if not any(hint in low for hint in HINTS):
        return []
    found = {m.span(m.lastindex): m[m.lastindex] for pattern in (FIELD, BEARER) for m in pattern.finditer(text)}
    costs = ((s, e, guess_log10(value, model)) for (s, e), value in found.items() if e - s >= model.min_length)
    return sorted((s, 3, e, cost) for s, e, cost in costs if cost >= model.min_log10)


KINDS = ("assign", "access", "hex", "guess")
SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, max_log10 double, "
    "base_spans string, spans string"
)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_batches(batches: Iterator[pa.RecordBatch], model: GuessModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list] = [[] for _ in range(7)]
        for scalar in batch.column(1):
            text = scalar.as_py() or ""
            base, guessed = base_spans(text), guessed_spans(text, model)
            kinds = [kind for _, kind, _ in base]
            every = sorted(base + [span[:3] for span in guessed])
            row = (*map(kinds.count, range(3)), len(guessed), max((c for *_, c in guessed), default=None))
            for column, value in zip(columns, (*row, _joined(base), _joined(every)), strict=True):
                column.append(value)
        kinds = [pa.int64()] * 4 + [pa.float64()] + [pa.string()] * 2
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)


def scan_secrets(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: GuessModel = GuessModel()
) -> DataFrame:
    """One row per row of ``docs``: counts by kind, and all spans as ``kind:start:end`` in code points.

    Null and empty texts have no spans (counts 0, empty strings); a null id stays
    null; repeated rows are each reported. Other columns are not read. Spans of
    one start stand in the order of ``KINDS``.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return mapped(rows, scan_batches, SCHEMA, model)


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
        "n_guess",
        "max_log10",
    )


def base_digest(text: str) -> str:
    return sha256(_joined(base_spans(text)).encode()).hexdigest()
