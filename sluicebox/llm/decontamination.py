"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items are normalised to words and all go into one suffix automaton over words. A text's words are streamed through it;
the matching length at each word tells which windows of WINDOW item words end there (an item of fewer words is one
window). Words inside such windows are hit. A text is contaminated if at least a twentieth of its words are hit.

The items of one automaton are bounded (BLOCK_CHARS): more of them are dealt into blocks by hash, each block is matched
against all texts, and only texts that are hit go into the merge of the blocks.

Defined results: null and wordless texts have no hits and are not contaminated; null and wordless items have no windows;
an item with a null id hits words and is named by empty text; equal items are all named; repeated documents get equal
results; without items nothing is hit. Only doc_id, text and item_id are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import SLICE_ROWS, map_texts

WINDOW = 13
SHARE = 20
BLOCK_CHARS = 4_000_000
#: ASCII bytes that are no part of a word; A-Z become a-z.
TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(TO_WORDS).split() if text else []


class ItemAutomaton:
    """Suffix automaton of several word sequences; ``windows`` lists the windows that occur in a word sequence."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.vocabulary: set[bytes] = set()
        ends: list[tuple[str, int, list[int]]] = []
        for name, words in items:
            if words:
                self.vocabulary.update(words)
                self._insert(words)
                ends.append((name, len(words), words))
        self.names: dict[int, set[str]] = {}
        self.shortest = window
        self.whole: dict[int, dict[int, set[str]]] = {}
        for name, size, words in ends:
            need = min(size, window)
            self.shortest = min(self.shortest, need)
            state, held = 0, 0
            for word in words:
                state, held = self.next[state][word], held + 1
                if held >= window:
                    self.names.setdefault(self._suffix(state, window), set()).add(name)
            if size < window:
                self.whole.setdefault(self._suffix(state, size), {}).setdefault(size, set()).add(name)
        self.short = self._short_suffixes()
        self.runs = re.compile(b"\x01{%d,}" % self.shortest)

    def _insert(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def _extend(self, last: int, word: bytes) -> int:
        following = self.next[last].get(word)
        if following is not None:
            return following if self.length[following] == self.length[last] + 1 else self._split(last, word, following)
        state = self._state({}, self.length[last] + 1, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            target = self.next[at][word]
            self.link[state] = target if self.length[target] == self.length[at] + 1 else self._split(at, word, target)
        return state

    def _state(self, moves: dict[bytes, int], length: int, link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, at: int, word: bytes, target: int) -> int:
        """A copy of ``target`` for its suffixes that are reached from ``at``."""
        copy = self._state(dict(self.next[target]), self.length[at] + 1, self.link[target])
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _suffix(self, state: int, length: int) -> int:
        """The state that holds the last ``length`` words of ``state``."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _short_suffixes(self) -> list[tuple[int, ...]]:
        """For each state the states on its suffix chain that hold whole short items."""
        found: list[tuple[int, ...]] = [()] * len(self.next)
        if self.whole:
            for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
                found[state] = found[self.link[state]] + ((state,) if state in self.whole else ())
        return found

    def windows(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal runs [start, end) of hit words, and the names of the items that have an occurring window."""
        spans: list[tuple[int, int]] = []
        names: set[str] = set()

        def hit(start: int, end: int) -> None:
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append((start, end))

        for run in self.runs.finditer(bytes(map(self.vocabulary.__contains__, words))):
            state = held = 0
            for i in range(*run.span()):
                word = words[i]
                while state and word not in self.next[state]:
                    state = self.link[state]
                    held = self.length[state]
                if word in self.next[state]:
                    state, held = self.next[state][word], held + 1
                if held >= self.window:
                    found = self.names.get(self._suffix(state, self.window))
                    if found:
                        names |= found
                        hit(i + 1 - self.window, i + 1)
                for at in self.short[state]:
                    for size, found in self.whole[at].items():
                        if size <= held:
                            names |= found
                            hit(i + 1 - size, i + 1)
        return spans, names


def item_blocks(items: DataFrame) -> list[list[tuple[str, str]]]:
    """(item_id, text) lists, each of bounded size; together they are all items that have text."""
    known = items.where(F.col("text").isNotNull()).select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), "text")
    total = known.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = 1 + total // BLOCK_CHARS
    block = F.pmod(F.xxhash64("name", "text"), F.lit(n))
    return [[(row["name"], row["text"]) for row in known.where(block == b).collect()] for b in range(n)]


def _match(docs: DataFrame, block: list[tuple[str, str]], window: int) -> DataFrame:
    def start():
        automaton = ItemAutomaton([(name, words_of(text)) for name, text in block], window)

        def run(texts):
            counts, starts, ends, names = [], [], [], []
            for text in texts:
                words = words_of(text)
                spans, found = automaton.windows(words) if automaton.vocabulary else ([], set())
                counts.append(len(words))
                starts.append([s for s, _ in spans])
                ends.append([e for _, e in spans])
                names.append(sorted(found))
            return [counts, starts, ends, names]

        return run

    kept = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash")) if "_hash" not in docs.columns else docs
    return map_texts(kept, start, "n_words bigint, starts array<int>, ends array<int>, items array<string>", keep="doc_id _hash")


def find_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, starts, ends, items) per document: hit word runs, and the ids of items, sorted as text."""
    return _hits(docs, item_blocks(items), window).drop("_hash")


def _hits(docs: DataFrame, blocks: list[list[tuple[str, str]]], window: int = WINDOW) -> DataFrame:
    docs = docs.select("doc_id", "text")
    first = _match(docs, blocks[0], window)
    if len(blocks) == 1:
        return first
    more = [_match(docs, block, window).where(F.size("starts") > 0).distinct() for block in blocks[1:]]
    merged = None
    for part in more:
        merged = part if merged is None else merged.unionByName(part)
    merged = merged.groupBy("doc_id", "_hash").agg(
        F.flatten(F.collect_list("starts")).alias("s"), F.flatten(F.collect_list("ends")).alias("e"), F.flatten(F.collect_list("items")).alias("i")
    )
    merged = merged.withColumnsRenamed({"doc_id": "m_id", "_hash": "m_hash"})
    joined = first.join(merged, F.col("doc_id").eqNullSafe(F.col("m_id")) & F.col("_hash").eqNullSafe(F.col("m_hash")), "left")
    none = F.array().cast("array<int>")
    both = joined.select(
        "doc_id",
        "_hash",
        "n_words",
        F.array_sort(F.arrays_zip(F.concat("starts", F.coalesce("s", none)).alias("s"), F.concat("ends", F.coalesce("e", none)).alias("e"))).alias("spans"),
        F.array_sort(F.array_distinct(F.concat("items", F.coalesce("i", F.array().cast("array<string>"))))).alias("items"),
    )

    def united(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            starts, ends = [], []
            for spans in batch["spans"]:
                out: list[list[int]] = []
                for span in spans:
                    if out and span["s"] <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], span["e"])
                    else:
                        out.append([span["s"], span["e"]])
                starts.append([s for s, _ in out])
                ends.append([e for _, e in out])
            yield batch[["doc_id", "_hash", "n_words"]].assign(starts=starts, ends=ends, items=batch["items"])

    return both.mapInPandas(united, first.schema)


def judged(hits: DataFrame) -> DataFrame:
    """Adds n_hit and contaminated to the result of ``find_hits``."""
    n_hit = F.aggregate(F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("bigint"), lambda a, b: a + b)
    rows = hits.withColumn("n_hit", n_hit)
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return judged(find_hits(docs, items)).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def without_spans(text: str, starts: list[int], ends: list[int]) -> str:
    """The text without the word runs [start, end); what stands between two removed words goes too."""
    places = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for start, end in zip(starts, ends):
        kept.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "".join(kept) + text[at:]


def _cleaned(text: str, automaton: ItemAutomaton) -> str | None:
    words = words_of(text)
    spans, _ = automaton.windows(words)
    n_hit = sum(end - start for start, end in spans)
    if n_hit and SHARE * n_hit >= len(words):
        return None
    return without_spans(text, *zip(*spans)) if spans else text


def stage(docs: DataFrame, items: DataFrame) -> DataFrame:
    """All columns of the documents that are not contaminated, with the hit spans of the others cut out of their text.

    n_chars, where there is such a column, follows a changed text.
    """
    blocks = item_blocks(items)
    row = docs.select(F.struct(*(docs[name] for name in docs.columns)).alias("doc"))  # columns may have any name
    if len(blocks) == 1:
        named = [(name, words_of(text)) for name, text in blocks[0]]

        @F.arrow_udf("string")
        def cleaned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            automaton = ItemAutomaton(named)
            for texts in batches:
                parts = [pa.array([], pa.string())]
                for at in range(0, len(texts), SLICE_ROWS):  # only few texts are Python strings at a time
                    some = texts.slice(at, SLICE_ROWS).to_pylist()
                    parts.append(pa.array([None if text is None else _cleaned(text, automaton) for text in some], pa.string()))
                yield pa.concat_arrays(parts)

        cleaned = cleaned.asNondeterministic()  # else Spark runs it twice, in two Python workers a task: for the filter and for the column
        rows = row.withColumn("clean", cleaned("doc.text"))
    else:
        hits = judged(_hits(docs, blocks)).where("n_hit > 0").select(
            F.col("doc_id").alias("_id"), "_hash", "starts", "ends", "contaminated"
        ).distinct()

        @F.pandas_udf("string")
        def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
            return pd.Series([t if s is None else without_spans(t, s, e) for t, s, e in zip(texts, starts, ends)])

        cut = cut.asNondeterministic()
        same = F.col("doc.doc_id").eqNullSafe(F.col("_id")) & F.xxhash64("doc.text").eqNullSafe(F.col("_hash"))
        clean = F.when(~F.coalesce("contaminated", F.lit(False)), cut("doc.text", "starts", "ends"))
        rows = row.join(hits, same, "left").withColumn("clean", clean)
    kept = rows.where(F.col("doc.text").isNull() | F.col("clean").isNotNull())
    columns = {name: F.col("doc")[name] for name in docs.columns} | {"text": F.col("clean")}
    if "n_chars" in columns:
        changed = F.col("clean") != F.col("doc.text")
        columns["n_chars"] = F.when(changed, F.char_length("clean")).otherwise(F.col("doc.n_chars")).cast(docs.schema["n_chars"].dataType)
    return kept.select(*[column.alias(name) for name, column in columns.items()])
