"""Toxicity: Levenshtein automata over a lexicon trie, and the window around each hit."""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import batches_of, crc_of_id
from starload.session import written

MOST_LABELLED = 50_000
"""Labelled rows a model is fitted on, those of the least id hash; a fit beyond them changes little."""
MOST_STATES = 150_000
MOST_WORDS = 300_000
"""Automaton states and words with their terms that a task remembers; beyond, it starts to remember anew."""
BLOCK_TOKENS = 50_000
"""Tokens of a text held at once."""
_BATCH_BYTES = 1 << 20
LEAST_TEXTS = 3
"""Toxic texts a term must be in, however many there are."""
LEAST_ODDS = 3.0
LEAST_G = 24.0
"""Log-likelihood ratio a term must reach: beyond what the best of some 100,000 chance words does."""
STEMS = range(4, 8)
WINDOW = 6
"""Tokens on either side of a hit that tell quotation from abuse."""
# Marks that open or close a quotation, and verbs that report speech, in the corpus's languages.
QUOTES = "\"“”„«»‹›‘’"
REPORTING = frozenset(
    "said says say wrote writes called calls quoted quote quotes reported reports word term slur "
    "dit écrit appelé cité mot terme sagte sagt schrieb nannte zitiert wort begriff "
    "dijo dice escribió llamó citó palabra término".split()
)
# A single curly mark between two letters is an apostrophe.
_TOKEN = re.compile(rf"[^\W_]+|(?<![^\W\d_])[‘’]|[‘’](?![^\W\d_])|[{QUOTES.strip('‘’')}]")
CLOSING = {'"': '"', "“": "”", "”": "”", "„": "“”", "«": "»", "»": "«»", "‹": "›", "›": "‹›", "‘": "’", "’": "’"}
"""Marks that may close what a mark opens, in the corpus's languages."""


@dataclass(frozen=True)
class Term:
    text: str
    weight: float
    stem: bool
    """Whether any word that begins with the text is meant."""

    @property
    def edits(self) -> int:
        n = len(self.text)
        return 0 if n < 5 or (self.stem and n < 7) else 1 if n < 8 else 2


class Automaton:
    """All Levenshtein automata of a lexicon at once, intersected with its trie and made deterministic as needed.

    A state is the set of (trie node, edits so far) that a prefix of the word can have led to. Its
    successor per character is worked out on first use and kept, so a word costs one look-up per
    character and ends as soon as no term is within reach. Of states and words only so many are kept; what is
    forgotten is worked out again, to the same result.
    """

    def __init__(self, terms: Sequence[Term]):
        self.children: list[dict[str, int]] = [{}]
        self.terms: list[list[Term]] = [[]]
        self.reach = [0]
        for term in terms:
            node = 0
            self.reach[0] = max(self.reach[0], term.edits)
            for c in term.text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.terms.append([])
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], term.edits)
            self.terms[node].append(term)
        self.found: dict[str, tuple[float, int] | None] = {}
        self._forget()

    def _forget(self) -> None:
        self.sets: list[bytes] = []
        """Per state its nodes and edits, packed into 32 bits each: node * 4 + edits, in order."""
        self.numbers: dict[bytes, int] = {}
        self.steps: list[dict[str, int]] = []
        self.whole: list[tuple[float, int] | None] = []
        self.begun: list[tuple[float, int] | None] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """Number of the state with the least edits per node, after leaving out characters of terms."""
        least: dict[int, int] = {}
        stack = list(nodes.items())
        while stack:
            node, edits = stack.pop()
            if edits > self.reach[node] or least.get(node, 99) <= edits:
                continue
            least[node] = edits
            stack.extend((child, edits + 1) for child in self.children[node].values())
        state = array("I", sorted(4 * node + edits for node, edits in least.items())).tobytes()
        if state not in self.numbers:
            self.numbers[state] = len(self.sets)
            self.sets.append(state)
            self.steps.append({})
            hits = [(t.weight, -e, t.stem) for node, e in least.items() for t in self.terms[node] if e <= t.edits]
            self.whole.append(max(((w, -e) for w, e, _ in hits), key=_rank, default=None))
            self.begun.append(max(((w, -e) for w, e, stem in hits if stem), key=_rank, default=None))
        return self.numbers[state]

    def _step(self, state: int, c: str) -> int:
        after: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            after[node] = min(edits, after.get(node, 99))

        for packed in array("I", self.sets[state]):
            node, edits = packed >> 2, packed & 3
            reach(node, edits + 1)
            for letter, child in self.children[node].items():
                reach(child, edits + (letter != c))
        self.steps[state][c] = following = self._state(after)
        return following

    def look_up(self, word: str) -> tuple[float, int] | None:
        """(weight, edits) of the term the word means, the fewest edits first; None when it means none."""
        if word in self.found:
            return self.found[word]
        if len(self.sets) > MOST_STATES:
            self._forget()
        state, best = self.start, None
        for c in word:
            after = self.steps[state].get(c)
            state = self._step(state, c) if after is None else after
            hit = self.begun[state]
            if hit and (best is None or _rank(hit) > _rank(best)):
                best = hit
            if not self.sets[state]:
                break
        else:
            hit = self.whole[state]
            if hit and (best is None or _rank(hit) > _rank(best)):
                best = hit
        if len(self.found) > MOST_WORDS:
            self.found.clear()
        self.found[word] = best
        return best


_LAST: list[tuple[tuple[Term, ...], Automaton]] = []


def automaton_of(terms: Sequence[Term]) -> Automaton:
    """The automaton of these terms; a worker's next task goes on with what its last one has worked out."""
    if not _LAST or _LAST[0][0] != tuple(terms):
        _LAST[:] = [(tuple(terms), Automaton(terms))]
    return _LAST[0][1]


def _rank(hit: tuple[float, int]) -> tuple[int, float]:
    return -hit[1], hit[0]


def token_blocks(text: str | None) -> Iterator[tuple[list[str], int, int]]:
    """Tokens of a text in blocks, each with the range of those that are its own and the windows around them."""
    text = (text or "").lower()
    if len(text) <= BLOCK_TOKENS:  # so it has no more tokens
        held = _TOKEN.findall(text)
        yield held, 0, len(held)
        return
    found = (m.group() for m in _TOKEN.finditer(text))
    held = list(islice(found, BLOCK_TOKENS + WINDOW))
    own = 0
    while True:
        more = list(islice(found, BLOCK_TOKENS))
        end = len(held) - WINDOW if more else len(held)
        yield held, own, end
        if not more:
            return
        held = held[max(0, end - WINDOW) :] + more
        own = min(WINDOW, end)


FEATURES = 6


def features(blocks: Iterable[tuple[list[str], int, int]], automaton: Automaton) -> list[float]:
    """Of one text: exact, misspelled and quoted hits, their best weight, their density, and any hit at all."""
    exact = near = quoted = size = 0
    best = 0.0
    look_up = automaton.look_up
    for held, own, end in blocks:
        size += end - own
        hits = {w: hit for w in set(held) if (hit := look_up(w))}
        for at in range(own, end) if hits else ():
            hit = hits.get(held[at])
            if hit is None:
                continue
            before, after = held[max(0, at - WINDOW) : at], held[at + 1 : at + 1 + WINDOW]
            marked = any(w in CLOSING and any(a in CLOSING[w] for a in after) for w in before)
            if marked or not REPORTING.isdisjoint(before):
                quoted += 1
                continue
            best = max(best, hit[0] / (1 + hit[1]))
            if hit[1]:
                near += 1
            else:
                exact += 1
    return [
        math.log1p(exact), math.log1p(near), math.log1p(quoted), best,
        math.log1p(1000 * (exact + near) / max(size, 1)), float(exact + near > 0),
    ]


def term_counts(labelled: DataFrame) -> DataFrame:
    """(term, stem, toxic, clean): labelled texts of either kind holding a word, or a word so begun."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in (part for whole in batches for part in batches_of(whole, _BATCH_BYTES)):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = {w for held, own, end in token_blocks(text) for w in held[own:end] if w.isalpha()}
                kinds = {(w, False) for w in words if len(w) >= 3}
                kinds.update((w[:n], True) for w in words for n in STEMS if len(w) >= n)
                seen[toxic].update(kinds)
        for toxic in (0, 1):
            rows = list(seen[toxic].items())
            for at in range(0, len(rows), 100_000):
                part = rows[at : at + 100_000]
                yield pa.RecordBatch.from_pydict({
                    "term": [t for (t, _), _ in part], "stem": [s for (_, s), _ in part],
                    "toxic": [n * toxic for _, n in part], "clean": [n * (1 - toxic) for _, n in part],
                })

    rows = labelled.mapInArrow(count, "term string, stem boolean, toxic long, clean long")
    return rows.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def lexicon(labelled: DataFrame, toxic: int, clean: int) -> list[Term]:
    """All terms far more frequent in toxic texts, and in at least LEAST_TEXTS, the strongest first.

    A stem that is nearly always one word gives way to the word. The labelled texts bound their number.
    """
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    share = (F.col("toxic") + F.col("clean")) / max(toxic + clean, 1)
    g = 2 * (
        F.col("toxic") * F.log(F.col("toxic") / (share * toxic))
        + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (share * clean))).otherwise(0.0)
    )
    found = (
        term_counts(labelled)
        .where(F.col("toxic") >= LEAST_TEXTS)
        .withColumn("odds", odds)
        .where((F.col("odds") >= LEAST_ODDS) & (g >= LEAST_G))
        .orderBy(F.desc(F.col("toxic") * F.col("odds")), "term", "stem")
        .collect()
    )
    said: dict[str, int] = {}
    """Per beginning of a word, the toxic texts that its commonest word is in."""
    for r in found:
        if not r["stem"]:
            for n in STEMS:
                said[r["term"][:n]] = max(said.get(r["term"][:n], 0), r["toxic"])
    terms: list[Term] = []
    stems: set[str] = set()
    for r in found:
        if any(r["term"][:n] in stems for n in STEMS):
            continue
        if r["stem"]:
            if said.get(r["term"], 0) >= 0.8 * r["toxic"]:
                continue
            stems.add(r["term"])
        terms.append(Term(r["term"], r["odds"], r["stem"]))
    return terms


def fitted(x: np.ndarray, y: np.ndarray, steps: int = 25) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last value is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1.0)
    ridge[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - ridge * beta
        beta = beta + np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + np.diag(ridge), grad)
    return beta


@dataclass(frozen=True)
class Model:
    terms: list[Term]
    beta: np.ndarray


def trained(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0,
            most_labelled: int = MOST_LABELLED) -> Model:
    """Lexicon and weights from the labelled rows whose fold is not ``held_out``, at most ``most_labelled``.

    Copies of one text count once, as toxic when any of them is labelled so.
    """
    wanted = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(
        F.pmod(crc_of_id(F.col("doc_id")), F.lit(folds)) != held_out
    )
    wanted = wanted.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = written(wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled), "toxic-labels")
    labelled = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("text").agg(
        F.max(F.least("toxic", F.lit(1))).alias("toxic")
    )
    labelled = written(labelled, "toxic-texts")
    toxic, clean = labelled.agg(
        F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))
    ).first()
    terms = lexicon(labelled, toxic, clean)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(terms)
        for batch in (part for whole in batches for part in batches_of(whole, _BATCH_BYTES)):
            rows = [features(token_blocks(t), automaton) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "toxic": batch.column("toxic"), "features": pa.array(rows, pa.list_(pa.float64()))
            })

    found = labelled.mapInArrow(measure, "toxic int, features array<double>").toPandas()
    x = np.array(found["features"].tolist(), float).reshape(len(found), FEATURES)
    return Model(terms, fitted(x, found["toxic"].to_numpy(float)) if toxic and clean else np.array([0.0] * FEATURES + [-3.0]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row, from its whole text alone.

    Null and empty texts have no hits and score as such; a long text is read in blocks of tokens. Repeated rows are scored each, an empty
    table gives no rows, other columns are ignored. A model without both kinds of labels scores every
    text alike and low.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(model.terms)
        for batch in (part for whole in batches for part in batches_of(whole, _BATCH_BYTES)):
            x = np.array([features(token_blocks(t), automaton) for t in batch.column("text").to_pylist()], float)
            z = x.reshape(batch.num_rows, FEATURES) @ model.beta[:-1] + model.beta[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=["doc_id", "score"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
