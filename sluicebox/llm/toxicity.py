"""Toxicity: Levenshtein automata meet a lexicon trie; context windows tell quotation from abuse.

The lexicon is learned: words that occur behind many different words in toxic texts and hardly ever in others. Its trie
is intersected with the Levenshtein automata of its terms (one edit from five letters, two from nine, none in the first
letter), determinised as texts ask for transitions. Each match is weighed in a window of words around it: quotation marks and words of report make
it quoted. A logistic regression of the evidence gives the score.

Defined results: null and empty texts have no evidence and get the score of a text without matches; repeated rows get
equal results; an empty label table, or one with a single label, gives score 0 everywhere. Only doc_id and text are read,
so other columns may have any name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import SLICE_ROWS, fit_labels, held_out, labelled_texts, logistic, map_texts, sigmoid

FIT_ROWS = 8_000
MIN_CONTEXTS = 5
MIN_ODDS = 15.0
WINDOW_WORDS = 6
CACHE_WORDS = 200_000
THRESHOLD = 0.7
WORD = re.compile(r"[^\W\d_]+")
QUOTES = frozenset("\"'“”„«»‘’‹›")
#: Words that report what somebody else said, in the languages the engine is used for.
REPORTED = frozenset(
    "said says say wrote writes called calls quoted quote quotes claimed word term "
    "sagte sagt schrieb nannte zitat dit disait appelé écrit citation dijo dice escribió llamó cita".split()
)


def edits_for(term: str) -> int:
    return 2 if len(term) >= 9 else 1 if len(term) >= 5 else 0


class FuzzyLexicon:
    """A trie of terms intersected with their Levenshtein automata; states are built when first reached.

    A state is a set of (trie node, edits so far). ``match`` gives (term, edits) of the nearest term, or None.
    """

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.allowed: list[int] = [0]
        for term in sorted(set(terms)):
            node = 0
            self.allowed[0] = max(self.allowed[0], edits_for(term))
            for char in term:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.allowed.append(0)
                node = self.children[node][char]
                self.allowed[node] = max(self.allowed[node], edits_for(term))
            self.term[node] = term
        self.alphabet = {char for node in self.children for char in node}
        self.sets: list[frozenset] = []
        self.ids: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.accepts: list[tuple[str, int] | None] = []
        self.start = 0
        self.sets.append(frozenset())
        self.steps.append({})
        self.accepts.append(None)

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """Close over skipped term letters, keep the fewest edits per node, and number the set; -1 is the dead state."""
        best: dict[int, int] = {}
        todo = sorted(pairs, key=lambda pair: pair[1])
        while todo:
            node, edits = todo.pop()
            if edits > self.allowed[node] or best.get(node, 9) <= edits:
                continue
            best[node] = edits
            todo.extend((child, edits + 1) for child in self.children[node].values())
        if not best:
            return -1
        key = frozenset(best.items())
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            found = [(e, self.term[v]) for v, e in key if self.term[v] is not None and e <= edits_for(self.term[v])]
            self.accepts.append((min(found)[1], min(found)[0]) if found else None)
        return self.ids[key]

    def _step(self, state: int, char: str) -> int:
        after = set()
        if state == self.start:  # the first letter stands as it is
            after = {(self.children[0][char], 0)} if char in self.children[0] else set()
            self.steps[state][char] = target = self._state(after)
            return target
        for node, edits in self.sets[state]:
            after.add((node, edits + 1))
            for letter, child in self.children[node].items():
                after.add((child, edits if letter == char else edits + 1))
        self.steps[state][char] = target = self._state(after)
        return target

    def match(self, word: str) -> tuple[str, int] | None:
        state = self.start
        for char in word:
            if char not in self.alphabet:
                char = ""
            following = self.steps[state].get(char)
            state = self._step(state, char) if following is None else following
            if state < 0:
                return None
        return self.accepts[state]


@dataclass
class ToxicityModel:
    """terms: term to weight. ordinary: words near a term that clean texts use. weights: of the evidence, or None."""

    terms: dict[str, float]
    ordinary: frozenset[str]
    weights: list[float] | None
    _lexicon: FuzzyLexicon | None = field(default=None, repr=False)
    _clean: set = field(default_factory=set, repr=False)
    _hits: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"terms": self.terms, "ordinary": self.ordinary, "weights": self.weights}

    def __setstate__(self, state):
        self.__init__(**state)

    def matches(self, text: str) -> list[tuple[re.Match, str, int]]:
        """(match in the text, term, edits) of each word that is a term or a misspelling of one."""
        if self._lexicon is None:
            self._lexicon = FuzzyLexicon(list(self.terms))
        lower = text.lower()
        new = set(WORD.findall(lower)) - self._clean
        wanted = []
        for word in new:
            hit = self._hits.get(word)
            if hit is None:
                hit = self._lexicon.match(word)
                if hit is None or hit[1] and word in self.ordinary:
                    self._clean.add(word)
                    continue
                self._hits[word] = hit
            wanted.append(word)
        if len(self._clean) > CACHE_WORDS:
            self._clean.clear()
        if len(self._hits) > CACHE_WORDS:
            self._hits.clear()
        if not wanted:
            return []
        held = {word: self._lexicon.match(word) for word in wanted}
        return [(m, *held[m.group()]) for m in WORD.finditer(lower) if m.group() in held]

    def evidence(self, text: str | None) -> list[float]:
        """Log sums of exact and misspelled matches, as abuse and as quotation, and the share of all words that match."""
        if not text:
            return [0.0] * 5
        sums, hits = [0.0] * 4, self.matches(text)
        if not hits:
            return [0.0] * 5
        lower = text.lower()
        words = [m.span() for m in WORD.finditer(lower)]
        starts = {span[0]: i for i, span in enumerate(words)}
        for m, term, edits in hits:
            at = starts[m.start()]
            first, last = max(0, at - WINDOW_WORDS), min(len(words) - 1, at + WINDOW_WORDS)
            before, after = lower[words[first][0] : m.start()], lower[m.end() : words[last][1]]
            marked = any(c in QUOTES for c in before) and any(c in QUOTES for c in after)
            quoted = marked or any(lower[a:b] in REPORTED for a, b in words[first : last + 1])
            sums[2 * (edits > 0) + quoted] += self.terms[term] / (1 + edits)
        return [*np.log1p(sums).tolist(), 100.0 * len(hits) / max(20, len(words))]

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(evidence))
        w = np.asarray(self.weights)
        return sigmoid(evidence @ w[:-1] + w[-1])


def _contexts(rows: DataFrame) -> DataFrame:
    """(word, before, toxic, clean): in how many toxic and clean texts of a task a word stands behind another."""

    def run(batches):
        toxic, clean = {}, {}
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = WORD.findall((text or "").lower())
                into = toxic if label else clean
                for pair in set(zip(words, ["", *words])):
                    into[pair] = 1
        pairs = list(toxic.keys() | clean.keys())
        for start in range(0, len(pairs), 50_000):
            part = pairs[start : start + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p[0] for p in part], pa.string()),
                    pa.array([p[1] for p in part], pa.string()),
                    pa.array([toxic.get(p, 0) for p in part], pa.int32()),
                    pa.array([clean.get(p, 0) for p in part], pa.int32()),
                ],
                ["word", "before", "toxic", "clean"],
            )

    return rows.select("text", "label").mapInArrow(run, "word string, before string, toxic int, clean int")


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> ToxicityModel:
    """Learn lexicon and weights from about ``rows`` labelled documents outside the held-out fold."""
    sample = fit_labels(labels, "toxic", rows).cache()
    counts = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        return ToxicityModel({}, frozenset(), None)
    texts = labelled_texts(docs, sample)
    words = (
        _contexts(texts)
        .groupBy("word", "before")
        .agg(F.max("toxic").alias("toxic"), F.max("clean").alias("clean"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    odds = (F.col("toxic") + 0.5) / (F.col("clean") + 0.5) * F.lit(counts[0] / counts[1])
    found = (
        words.where((F.length("word") >= 3) & (F.col("toxic") >= MIN_CONTEXTS) & (odds >= MIN_ODDS))
        .select("word", F.log(odds).alias("weight"))
        .collect()
    )
    model = ToxicityModel({row["word"]: row["weight"] for row in found}, frozenset(), None)

    model.ordinary = frozenset(row["word"] for row in words.where("clean > 0").select("word").mapInArrow(_near(model), "word string").collect())
    evidence = map_texts(texts, _evidence_columns(model), "evidence array<double>", keep="label").collect()
    model.weights = logistic(
        np.array([row["evidence"] for row in evidence]).reshape(-1, 5), np.array([row["label"] for row in evidence], float)
    ).tolist()
    sample.unpersist()
    return model


def _near(model: ToxicityModel):
    def run(batches):
        lexicon = FuzzyLexicon(list(model.terms))
        for batch in batches:
            near = [word for word in batch.column(0).to_pylist() if (hit := lexicon.match(word)) and hit[1]]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], ["word"])

    return run


def _evidence_columns(model: ToxicityModel):
    def start():
        return lambda texts: [[model.evidence(text) for text in texts]]

    return start


def score(docs: DataFrame, model: ToxicityModel, keep: str = "doc_id") -> DataFrame:
    """The ``keep`` columns, score and n_terms (matches) per document."""

    def start():
        def run(texts):
            rows = np.array([model.evidence(text) for text in texts]).reshape(-1, 5)
            return [model.scores(rows), rows[:, 4] > 0]

        return run

    return map_texts(docs, start, "score double, has_terms boolean", keep=keep)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "has_terms"
    )


def stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that are not predicted toxic, with all their columns."""
    model = fit(docs, labels)

    @F.arrow_udf("double")
    def toxicity(texts: pa.Array) -> pa.Array:
        found = [np.zeros(0)]
        for at in range(0, len(texts), SLICE_ROWS):  # only few texts are Python strings at a time
            rows = [model.evidence(text) for text in texts.slice(at, SLICE_ROWS).to_pylist()]
            found.append(model.scores(np.array(rows).reshape(-1, 5)))
        return pa.array(np.concatenate(found))

    return docs.where(toxicity("text") < THRESHOLD)
