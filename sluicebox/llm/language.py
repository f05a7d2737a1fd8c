"""Language identification by rank-order profiles.

Each language's profile is the order of its most frequent n-grams (one to three letters, with a mark where words begin
and end). A text's own most frequent n-grams are held against every profile; the sum of how far each is out of its place
decides. Counts for the profiles are taken over all texts outside the held-out fold.

Defined results: null, empty and letterless texts get ``und`` and score 0; equal frequencies are ordered by code point;
equal distances go to the smaller language name; repeated rows get equal results; an empty table gives no rows, and no
training texts give ``und`` everywhere. Only doc_id, text and, for training, lang are read; other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluicebox.llm.common import SLICE_ROWS, held_out, letter_table, map_texts

PROFILE = 400
ORDERS = (1, 2, 3)
DENSE_LETTERS = 96
BATCH_CHARS = 2_000_000
EDGE = 1  # code point that marks the border of a word; no letter


def marked_letters(text: str) -> np.ndarray:
    """The text's lower-case letters; every run of other characters becomes one border, at both ends too."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = letter_table()[codes]
    letters = np.concatenate([[0], letters, [0]])
    other = letters == 0
    keep = np.ones(len(letters), dtype=bool)
    keep[1:] = ~(other[1:] & other[:-1])
    return np.where(other, EDGE, letters)[keep]


def ngram_counts(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of marked letters as numbers (21 bits a letter) with their counts; a lone border is no n-gram."""
    present = np.bincount(letters) > 0
    alphabet = np.flatnonzero(present)
    small = (np.cumsum(present) - 1)[letters]
    codes, counts = [], []
    size = len(alphabet)
    for order in ORDERS:
        if len(letters) < order:
            continue
        stop = len(letters) - order + 1
        gram = np.zeros(stop, dtype=np.int64)
        if size <= DENSE_LETTERS:
            for k in range(order):
                gram = gram * size + small[k : k + stop]
            found = np.bincount(gram, minlength=1)
            used = np.flatnonzero(found)
            number, rest = np.zeros(len(used), dtype=np.int64), used.copy()
            for k in range(order):
                number |= alphabet[rest % size].astype(np.int64) << (21 * k)
                rest //= size
            many = found[used]
        else:
            for k in range(order):
                gram = (gram << 21) | letters[k : k + stop]
            number, many = np.unique(gram, return_counts=True)
        real = (number != EDGE) if order == 1 else np.ones(len(number), dtype=bool)
        codes.append(number[real])
        counts.append(many[real])
    return np.concatenate(codes), np.concatenate(counts)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))][:size]


class Profiles:
    """Rank-order profiles by language; ``predict`` gives (language, score)."""

    def __init__(self, ranks: dict[str, list[int]]):
        self.languages = sorted(ranks)
        known = sorted({code for order in ranks.values() for code in order})
        self.known = np.array(known, dtype=np.int64)
        self.places = np.full((len(self.languages), len(known)), PROFILE, dtype=np.int64)
        self.missing = PROFILE
        for i, language in enumerate(self.languages):
            self.places[i, np.searchsorted(self.known, np.array(ranks[language], dtype=np.int64))] = np.arange(len(ranks[language]))

    def predict(self, text: str | None) -> tuple[str, float]:
        letters = marked_letters(text) if text else np.array([EDGE])
        if not self.languages or not (letters != EDGE).any():
            return "und", 0.0
        own = ranked(*ngram_counts(letters))
        at = np.searchsorted(self.known, own)
        at[at == len(self.known)] = 0
        seen = self.known[at] == own
        own_place = np.arange(len(own))
        places = np.where(seen, self.places[:, at], self.missing)
        distance = np.where(places < self.missing, np.abs(places - own_place), self.missing).sum(axis=1)
        best = int(distance.argmin())
        return self.languages[best], 1.0 - float(distance[best]) / (self.missing * len(own))


def profile_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each n-gram occurs in all texts of a language."""

    def run(batches):
        sums: dict[str, dict[int, int]] = {}
        held: dict[str, list[np.ndarray]] = {}
        chars = 0

        def take():
            for language, pieces in held.items():
                into = sums.setdefault(language, {})
                codes, counts = ngram_counts(np.concatenate(pieces))
                for code, count in zip(codes.tolist(), counts.tolist()):
                    into[code] = into.get(code, 0) + count
            held.clear()

        def give():
            for language, grams in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(grams)), pa.array(list(grams), pa.int64()), pa.array(list(grams.values()), pa.int64())],
                    ["lang", "gram", "n"],
                )
            sums.clear()

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                for language, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    letters = marked_letters(text)
                    held.setdefault(language, []).append(letters)
                    chars += len(letters)
                if chars > BATCH_CHARS:
                    take()
                    chars = 0
                    if sum(map(len, sums.values())) > 200_000:
                        yield from give()
        take()
        yield from give()

    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counted = rows.mapInArrow(run, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> Profiles:
    """Profiles from the given texts: at most PROFILE n-grams per language reach the driver.

    Borders between two texts of one batch form n-grams across them only over a border mark, as between words of one text.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranks = profile_counts(docs).withColumn("place", F.row_number().over(order)).where(F.col("place") <= PROFILE)
    found: dict[str, list[tuple[int, int]]] = {}
    for row in ranks.select("lang", "gram", "place").collect():
        found.setdefault(row["lang"], []).append((row["place"], row["gram"]))
    return Profiles({language: [gram for _, gram in sorted(grams)] for language, grams in found.items()})


def predict(docs: DataFrame, profiles: Profiles, keep: str = "doc_id") -> DataFrame:
    def start():
        def run(texts):
            found = [profiles.predict(text) for text in texts]
            return [[f[0] for f in found], [f[1] for f in found]]

        return run

    return map_texts(docs, start, "lang_pred string, score double", keep=keep)


def query(docs: DataFrame) -> DataFrame:
    profiles = fit(docs.where(~held_out()))
    return predict(docs, profiles).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
