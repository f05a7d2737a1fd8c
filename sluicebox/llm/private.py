"""Personal data: fixed shapes, and contextual extraction bootstrapped from them.

Spans of fixed shape (addresses, numbers) are the seed entities. What stands before them, a word or a label glued to the
value as in ``mail=...``, is a lexical pattern. Every token with a digit or an at-sign is an instance of the patterns it
stands in. Rounds over the graph of patterns and instances give a pattern the mean score of its instances, times the share of its
occurrences that are instances at all, and an instance the chance that one of its patterns is right. Instances behind
patterns of high confidence are identifiers too.

Defined results: null and empty texts have no spans; repeated rows get equal results; a table without seeds has no
patterns; an empty table gives no rows. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import SLICE_ROWS, map_texts, store

ROUNDS = 3
MIN_SEEDS = 5
CONFIDENCE = 0.8
PRIOR = 2.0
KINDS = ("email", "ip", "card", "phone", "id")
BASE = 4
#: The shapes of the base kinds.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SPACES_AND_DASHES = str.maketrans("", "", " -")
TOKEN = re.compile(r"\S*[0-9@]\S*")
LABEL = re.compile(r"(.*?[^\W\d_][=:#])(?=\S)")
EDGES = "\"'“”„«»‘’()[]{}<>,;:!?."


def luhn(digits: str) -> bool:
    total = 0
    for at, char in enumerate(reversed(digits)):
        value = int(char) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their at-signs."""
    found, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        last = domain.end() if domain else last
        if domain:
            found.append((start, last))
        at = text.find("@", max(last, at + 1))
    return found


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base kinds, in the order of kinds, then of starts."""
    if not text:
        return []
    found = [(0, *span) for span in emails(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().translate(SPACES_AND_DASHES)
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
    found += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m.group())) <= 15]
    return found


def instances(text: str | None, spans: list[tuple[int, int, int]]) -> list[tuple[str, str, int, int, bool]]:
    """(pattern, instance, start, end, seed): seeds and identifier-like tokens behind a word or a glued label."""
    if not text:
        return []
    taken, found = [], []
    for _, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if not taken or start >= taken[-1][1]:
            taken.append((start, end))
            found.append((start, end, True))
    k = 0
    for m in TOKEN.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k < len(taken) and taken[k][0] < m.end():
            continue
        start, end = m.span()
        label = LABEL.match(m.group())
        start += label.end() if label else 0
        while start < end and text[start] in EDGES:
            start += 1
        while end > start and text[end - 1] in EDGES:
            end -= 1
        if any(c in "0123456789@" for c in text[start:end]):
            found.append((start, end, False))
    out = []
    for start, end, seed in sorted(found):
        pattern = _before(text, start)
        if pattern:
            out.append((pattern, text[start:end], start, end, seed))
    return out


def _before(text: str, start: int) -> str | None:
    """The word, or glued label, before a place; None at the beginning of a line and behind a token with digits."""
    while start and text[start - 1] in "\"'“„«(":
        start -= 1
    end = start
    while end and text[end - 1] in " \t":
        end -= 1
    begin = end
    while begin and not text[begin - 1].isspace():
        begin -= 1
    word = text[begin:end].lower()
    if not word or any(c in "0123456789@" for c in word):
        return None
    return word if end < start else f"{word}+"


def spotted(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, spans, found): base spans and instances with their patterns, per document."""

    def start():
        def run(texts):
            spans = [base_spans(text) for text in texts]
            return [
                [[{"kind": k, "start": a, "end": b} for k, a, b in own] for own in spans],
                [
                    [dict(zip(("pattern", "instance", "start", "end", "seed"), one)) for one in instances(text, own)]
                    for text, own in zip(texts, spans)
                ],
            ]

        return run

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return map_texts(
        rows,
        start,
        "spans array<struct<kind:int,start:int,end:int>>, "
        "found array<struct<pattern:string,instance:string,start:int,end:int,seed:boolean>>",
        keep="doc_id text_hash",
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """(pattern, total): how often each word stands before another token of its line, over all texts."""

    def run(batches):
        counts: Counter = Counter()

        def give():
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["pattern", "total"])
            counts.clear()

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                for text in batch.column(0).slice(start, SLICE_ROWS).to_pylist():
                    counts.update((text or "").lower().split())
                if len(counts) > 300_000:
                    yield from give()
        yield from give()

    return docs.select("text").mapInArrow(run, "pattern string, total bigint").groupBy("pattern").agg(F.sum("total").alias("total"))


def confident_patterns(docs: DataFrame, seen: DataFrame) -> DataFrame:
    """(pattern, confidence) of the patterns that identify what stands behind them."""
    found = seen.select(F.explode("found").alias("f")).select("f.pattern", "f.instance", "f.seed")
    edges = store(found.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("times"), F.max("seed").alias("seed")), "private-graph")
    support = edges.groupBy("pattern").agg(F.sum("times").alias("times"), F.sum(F.col("seed").cast("int")).alias("seeds"))
    support = support.where(F.col("seeds") >= MIN_SEEDS)
    share = support.join(word_counts(docs), "pattern", "left").select(
        "pattern", F.least(F.lit(1.0), F.col("times") / F.coalesce("total", "times")).alias("share")
    )
    share = store(share, "private-share")
    graph = store(edges.join(share, "pattern"), "private-graph")
    score = F.when(F.col("seed"), 1.0).otherwise(0.0)
    patterns = None
    for _ in range(ROUNDS):
        scored = graph.withColumn("score", score) if patterns is None else _instance_scores(graph, patterns)
        mean = F.sum("score") / (F.count(F.lit(1)) + PRIOR)
        patterns = store(scored.groupBy("pattern").agg((mean * F.max("share")).alias("confidence")), "private-patterns")
    return patterns.where(F.col("confidence") >= CONFIDENCE)


def _instance_scores(graph: DataFrame, patterns: DataFrame) -> DataFrame:
    """The graph with each instance's chance that one of its patterns is right; seeds are certain."""
    edges = graph.join(patterns, "pattern")
    wrong = F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))
    chance = edges.groupBy("instance").agg((1 - wrong).alias("chance"))
    return edges.join(chance, "instance").withColumn("score", F.when(F.col("seed"), 1.0).otherwise(F.col("chance")))


def all_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, spans): base spans, and what confident patterns discover, per document."""
    seen = store(spotted(docs), "private-seen")
    patterns = store(confident_patterns(docs, seen), "private-confident")
    one = seen.where(F.exists("found", lambda f: ~f["seed"])).select("doc_id", "text_hash", F.explode("found").alias("f"))
    more = one.where(~F.col("f.seed")).select("doc_id", "text_hash", F.col("f.pattern").alias("pattern"), "f.start", "f.end").join(patterns, "pattern")
    span = F.struct(F.lit(BASE).alias("kind"), "start", "end")
    more = more.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(span)).alias("more"))
    more = more.withColumnsRenamed({"doc_id": "more_id", "text_hash": "more_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("more_id")) & F.col("text_hash").eqNullSafe(F.col("more_hash"))
    joined = seen.join(more, same, "left")
    return joined.select("doc_id", "text_hash", F.when(F.col("more").isNull(), F.col("spans")).otherwise(F.concat("spans", "more")).alias("spans"))


def _text_of(spans):
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def query(docs: DataFrame) -> DataFrame:
    found = all_spans(docs.select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] < BASE)

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{KINDS[k]}") for k in range(BASE)),
        F.sha2(_text_of(base), 256).alias("base_sha256"),
        _text_of(F.col("spans")).alias("spans"),
        count(BASE).alias("n_id"),
    )


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by the name of its kind; of overlapping spans the first and longest counts."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
            at = end
        else:
            at = max(at, end)
    return "".join(out) + text[at:]


def stage(docs: DataFrame) -> DataFrame:
    """All documents with all their columns; personal data in texts is masked, and n_chars follows where there is one."""
    found = all_spans(docs.select("doc_id", "text")).where(F.size("spans") > 0).distinct()
    found = store(found, "private-spans").withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash", "spans": "_spans"})

    @F.pandas_udf("string")
    def mask(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([masked(t, [(s["kind"], s["start"], s["end"]) for s in own]) for t, own in zip(texts, spans)], dtype=object)

    row = docs.select(F.struct(*(docs[name] for name in docs.columns)).alias("doc"), F.xxhash64("text").alias("hash"))  # columns may have any name
    same = F.col("doc.doc_id").eqNullSafe(F.col("_id")) & F.col("hash").eqNullSafe(F.col("_hash"))
    joined = row.join(found, same, "left")
    hit = joined.where(F.col("_spans").isNotNull()).withColumn("masked", mask(F.col("doc.text"), F.col("_spans")))
    columns = {name: F.col("doc")[name] for name in docs.columns} | {"text": F.col("masked")}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("masked").cast(docs.schema["n_chars"].dataType)
    hit = hit.select(*[column.alias(name) for name, column in columns.items()])
    return joined.where(F.col("_spans").isNull()).select("doc.*").unionByName(hit)
