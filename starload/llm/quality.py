"""Quality rules as a short-circuit cascade, ordered by what they reject per unit of cost on a sample."""

from __future__ import annotations

import operator
import string
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm.common import batches_of

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LONG = 50_000
"""Words from which on a text's windows are numbered rather than held one by one."""
_BATCH_BYTES = 1 << 20
_SAMPLED = 32
"""Rows at the head of every partition on which the rules are tried."""


def covered_by(starts: Iterable[int]) -> int:
    """Words inside the windows that begin at these places, in order."""
    covered = end = 0
    for i in starts:
        covered += i + WINDOW - max(i, end)
        end = i + WINDOW
    return covered


def repeated_windows(words: list[bytes]) -> list[int]:
    """Where the windows begin that occur at least twice, in a few numbers per word.

    Runs of one, two, four and eight words get numbers in turn, equal runs equal ones: a run is named by the
    numbers of its halves, so nothing rests on hashes.
    """
    known: dict[bytes, int] = {}
    run = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    size = 1
    while size < WINDOW:
        run = np.unique(run[:-size] * (len(words) + 1) + run[size:], return_inverse=True)[1]
        size *= 2
    return np.flatnonzero(np.bincount(run)[run] > 1).tolist()


class Measures:
    """What the rules ask of one text. Each value is worked out on first use and then kept."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def data(self) -> bytes:
        return self.text.encode()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside a window of eight that occurs at least twice, its first place included."""
        if self.n_words > LONG:
            return covered_by(repeated_windows(self.words))
        windows = list(zip(*(self.words[i:] for i in range(WINDOW))))
        if len(set(windows)) == len(windows):
            return 0
        first: dict[tuple, int] = {}
        repeated = set()
        for i, window in enumerate(windows):
            if first.setdefault(window, i) != i:
                repeated.update((first[window], i))
        return covered_by(sorted(repeated))

    def count_of(self, characters: str) -> int:
        return len(self.data) - len(self.data.translate(None, characters.encode()))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


BASE = (
    Rule("few_words", lambda m: m.n_words < 20),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 30 * m.n_words),
)
RULES = (
    *BASE,
    Rule("symbols", lambda m: 5 * m.n_symbols > m.n_words),
    Rule("shouting", lambda m: m.count_of(string.ascii_uppercase) > m.count_of(string.ascii_lowercase)),
    Rule("stutter", lambda m: 10 * sum(map(operator.eq, m.words, m.words[1:])) > 3 * m.n_words),
    Rule("repeated_lines", lambda m: 10 * m.n_dup_lines > 5 * len(m.lines)),
    Rule("digits", lambda m: 10 * m.count_of(string.digits) > 3 * m.word_chars),
    Rule("word_length", lambda m: not 2 * m.n_words <= m.word_chars <= 20 * m.n_words),
)


def cascade_order(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = _SAMPLED) -> list[Rule]:
    """The rules by rejected texts per second on a sample, best first.

    The sample is the first ``sample_rows`` rows of every partition, wherever in the table it lies. Each task
    tries the rules on its own and stops reading; only a row per rule leaves it. It decides only which rule is
    asked first: a text is kept when no rule rejects it, in any order.
    """

    def trial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, rejected = [0.0] * len(rules), [0] * len(rules)
        left = sample_rows
        for batch in batches:
            for part in batches_of(batch.slice(0, left), _BATCH_BYTES):
                for text in part.column("text").to_pylist():
                    for k, rule in enumerate(rules):
                        alone = Measures(text)
                        began = time.perf_counter()
                        rejected[k] += rule.rejects(alone)
                        spent[k] += time.perf_counter() - began
            left -= batch.num_rows
            if left <= 0:
                break
        yield pa.RecordBatch.from_pydict({"rule": list(range(len(rules))), "s": spent, "n": rejected})

    sampled = docs.select("text").mapInArrow(trial, "rule long, s double, n long")
    found = sampled.groupBy("rule").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    gain = {r["rule"]: r["n"] / (r["s"] + 1e-9) for r in found}
    return [rules[k] for k in sorted(range(len(rules)), key=lambda k: (-gain.get(k, 0.0), k))]


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES, measures: Sequence[str] = ()) -> DataFrame:
    """doc_id, the named measures, base_failed and kept for every row.

    The cascade stops at the first rule that rejects. A null or empty text has no words and fails;
    whole texts are read, a few at a time, long ones in a few numbers per word. Repeated rows are judged each,
    an empty table gives no rows, other columns are ignored.
    """
    order = cascade_order(docs, rules)
    base = [r for r in rules if r in BASE]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in batches_of(whole, _BATCH_BYTES)):
            rows = []
            for text in batch.column("text").to_pylist():
                m = Measures(text)
                kept = not any(rule.rejects(m) for rule in order)
                failed = not kept and any(rule.rejects(m) for rule in base)
                rows.append([*(getattr(m, name) for name in measures), failed, kept])
            columns = list(zip(*rows)) if rows else [()] * (len(measures) + 2)
            types = [pa.int64()] * len(measures) + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["doc_id", *measures, "base_failed", "kept"],
            )

    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
    fields += [T.StructField(name, T.LongType()) for name in measures]
    fields += [T.StructField(name, T.BooleanType()) for name in ("base_failed", "kept")]
    return docs.select("doc_id", "text").mapInArrow(judge, T.StructType(fields))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns as they are.

    Null, empty and blank texts have no words and go. Repeated rows stay or go together, an empty table gives no
    rows. Texts are looked at a few at a time, whatever the size of the batches they come in.
    """
    order = cascade_order(docs, rules)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in batches_of(whole, _BATCH_BYTES)):
            texts = batch.column("text").to_pylist()
            yield batch.filter(pa.array([not any(r.rejects(m) for r in order) for m in map(Measures, texts)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
