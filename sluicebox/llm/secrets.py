"""Secret scans over a trigram inverted index. DataFrame functions only; patterns are taken apart on the driver.

Each rule is a regular expression. ``trigram_query`` derives from it what every match must hold: clauses that must all be
met, each by one of its alternatives, each alternative being trigrams that must all occur. The index keeps, for every trigram
that some rule asks for, the posting lists of the texts that hold it (``index``). A rule's candidates are the intersections
and unions of posting lists that its query says (``candidates``); only they are searched with the expression itself
(``findings``). Rules without mandatory trigrams, such as runs of hex digits, scan every text.

Texts stand in the index by a 64-bit hash. Two texts with one hash are both searched if either is a candidate, so a collision
can cost time but never a match. Equal texts are one entry, so copies do not lengthen a list; lists are cut into buckets of
about BUCKET_TEXTS texts. Trigrams are compared in lower case, so one index serves rules with and without case.

Candidates go back to their documents by a join on the hash: broadcast while their stored table is small, else sort-merged,
where adaptive execution splits the partition of a text that repeats very often.

Defined results: null counts as empty text; matches of a kind are leftmost and do not overlap, and those under the
kind's least length are dropped without another try; spans of different kinds may overlap; repeated rows get equal results;
no documents give no rows. Whole texts are searched at any length. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import re._constants as op
import re._parser as pattern_parser
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import store

BUCKET_TEXTS = 20_000
MAX_STRINGS = 64  # strings that a part of a pattern may stand for before it is cut
CHUNK = 256
WORD_BITS = 62

Clause = frozenset[frozenset[str]]


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more. Patterns use what Java and RE2 both know."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


#: The kinds of the contract.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 1),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
)
#: Published shapes of keys and tokens.
ADDED = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("github", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"(?i:bearer)\x20+([A-Za-z0-9._~+/-]+)", 20, 1),
    Rule("url_login", r"[a-z]{2,12}://[A-Za-z0-9._-]+:[^\x00-\x20/:@]+@[A-Za-z0-9.-]+"),
)
RULES = BASE + ADDED


# --- what a pattern demands


def _least(clause: Clause) -> Clause:
    """Without the alternatives that ask for more than another one does."""
    return frozenset(a for a in clause if not any(b < a for b in clause))


def trigrams(text: str) -> frozenset[str]:
    low = text.lower()
    return frozenset(low[i : i + 3] for i in range(len(low) - 2))


def _class(members: list) -> set[str] | None:
    """The characters of a class, if they are few and ASCII."""
    out: set[str] = set()
    for kind, value in members:
        if kind is op.LITERAL and value < 128:
            out.add(chr(value).lower())
        elif kind is op.RANGE and value[1] < 128 and value[1] - value[0] < MAX_STRINGS:
            out |= {chr(code).lower() for code in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _alternatives(clauses: Sequence[Clause]) -> Clause | None:
    """One clause that says what all the given ones say, unless it gets too long."""
    out = {frozenset[str]()}
    for clause in clauses:
        out = {a | b for a, b in product(out, clause)}
        if len(out) > MAX_STRINGS:
            return None
    return frozenset(out) if clauses else None


def _demand(nodes: Sequence) -> tuple[set[str] | None, list[Clause]]:
    """(all strings that the nodes can match, or None; clauses that each match meets)."""
    whole, run, clauses = True, {""}, []

    def end_run() -> None:
        nonlocal run
        found = frozenset(trigrams(s) for s in run)
        if frozenset() not in found:
            clauses.append(found)
        run = {""}

    for kind, value in nodes:
        strings: set[str] | None = None
        inner: list[Clause] = []
        if kind is op.AT or kind is op.ASSERT or kind is op.ASSERT_NOT:
            continue
        if kind is op.LITERAL and value < 128:
            strings = {chr(value).lower()}
        elif kind is op.IN:
            strings = _class(value)
        elif kind is op.SUBPATTERN:
            strings, inner = _demand(value[3])
        elif kind is op.BRANCH:
            sides = [_demand(side) for side in value[1]]
            if all(s is not None for s, _ in sides):
                strings = set().union(*[s for s, _ in sides])
            else:
                each = [frozenset(map(trigrams, s)) if s is not None else _alternatives(c) for s, c in sides]
                if all(each) and not any(frozenset() in clause for clause in each):
                    inner = [frozenset().union(*each)]
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            least, most, part = value
            strings, inner = _demand(part)
            if strings is not None and most == least == 1 or strings is not None and (least, most) == (0, 1):
                strings = strings | {""} if least == 0 else strings
            else:
                if least and strings is not None:
                    inner = [c for c in [frozenset(map(trigrams, strings))] if frozenset() not in c]
                strings, inner = None, inner if least else []
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = {a + b for a, b in product(run, strings)}
            continue
        whole = False
        end_run()
        if strings is not None:
            run = strings
        clauses += inner
    if whole:
        return run, []
    end_run()
    return None, clauses


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that every match of a pattern meets; none if nothing is mandatory."""
    strings, clauses = _demand(list(pattern_parser.parse(pattern)))
    if strings is not None:
        clauses = [c for c in [frozenset(map(trigrams, strings))] if frozenset() not in c]
    return [_least(clause) for clause in clauses]


def asked_trigrams(rules: Sequence[Rule]) -> list[str]:
    return sorted({t for rule in rules for clause in trigram_query(rule.pattern) for alternative in clause for t in alternative})


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- index and candidates


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def index(docs: DataFrame, wanted: Sequence[str], bucket_texts: int = BUCKET_TEXTS) -> DataFrame:
    """Posting lists (bucket, trigram, ids) of the wanted trigrams over all distinct texts."""

    names = [f"w{start}" for start in range(0, len(wanted), WORD_BITS)]
    words = []
    for start in range(0, len(wanted), WORD_BITS):
        bits = (f"if(contains(low, {_quoted(t)}), {1 << k}L, 0L)" for k, t in enumerate(wanted[start : start + WORD_BITS]))
        words.append(" | ".join(bits))
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select(text_key(F.col("text")).alias("id"), F.expr(f"transform(array(lower(text)), low -> array({', '.join(words)}))[0]").alias("words"))
    marked = texts.groupBy("id").agg(*[F.bit_or(F.col("words")[k]).alias(name) for k, name in enumerate(names)])
    held = ", ".join(f"if(w{k - k % WORD_BITS} & {1 << k % WORD_BITS}L <> 0, {_quoted(t)}, NULL)" for k, t in enumerate(wanted))
    n_buckets = 1 + docs.count() // bucket_texts
    postings = marked.select(F.pmod("id", F.lit(n_buckets)).alias("bucket"), F.explode(F.expr(f"array_compact(array({held}))")).alias("trigram"), "id")
    return postings.groupBy("bucket", "trigram").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def candidates(postings: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(id, rules): texts that meet a rule's trigram query, with one bit per rule, by its place in ``rules``."""
    lists = postings.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("lists"))
    none = F.array().cast("array<bigint>")
    found = []
    for k, rule in enumerate(rules):
        clauses = trigram_query(rule.pattern)
        if clauses:
            ids = [
                reduce(F.array_union, [reduce(F.array_intersect, [F.coalesce(F.col("lists")[t], none) for t in sorted(alternative)]) for alternative in clause])
                for clause in clauses
            ]
            found.append(F.struct(F.lit(1 << k).cast("bigint").alias("rule"), reduce(F.array_intersect, ids).alias("ids")))
    if not found:
        return lists.select(F.lit(0).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("rules")).where("false")
    pairs = lists.select(F.explode(F.array(*found)).alias("hit")).select("hit.rule", F.explode("hit.ids").alias("id"))
    return pairs.groupBy("id").agg(F.bit_or("rule").alias("rules"))


# --- verification


def _scan(array: Column) -> Column:
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<bigint>").alias("out"))
    grown = F.aggregate(
        array,
        start,
        lambda acc, x: _let(acc["sum"] + x, lambda total: F.struct(total.alias("sum"), F.concat(acc["out"], F.array(total)).alias("out"))),
    )
    return grown["out"]


def _running(steps: Column) -> Column:
    """Running sums of a column of whole numbers. Chunks bound the copying that growing an array costs."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(steps), F.lit(1)), F.lit(CHUNK))

    def of_chunks(chunks: Column) -> Column:
        sums = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x))
        before = _let(sums, lambda own: F.zip_with(_scan(own), own, lambda total, one: total - one))
        return F.flatten(F.zip_with(chunks, before, lambda c, base: F.transform(_scan(c), lambda x: x + base)))

    return _let(F.transform(starts, lambda at: F.slice(steps, at, CHUNK)), of_chunks)


def spans(text: Column, rule: Rule, place: int) -> Column:
    """Array of (start, place, kind, end) in code points: what lies between the matches tells where they are.

    The text splits into one part more than it has matches; a match begins behind all parts and matches before it.
    """
    long = lambda c: F.char_length(c).cast("bigint")
    sizes = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), long)
    gaps = F.transform(F.split(text, rule.pattern), long)

    def placed(sizes: Column) -> Column:
        steps = F.zip_with(gaps, F.concat(F.array(F.lit(0).cast("bigint")), sizes), lambda gap, size: gap + size)
        starts = F.slice(_let(steps, _running), F.lit(1), F.size(sizes))
        return F.zip_with(
            starts, sizes, lambda a, n: F.struct(a.alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), (a + n).alias("end"))
        )

    all_spans = _let(sizes, placed)
    if rule.group:
        judged = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), long)
        return F.array_compact(F.zip_with(all_spans, judged, lambda s, n: F.when(n >= rule.least, s)))
    return F.filter(all_spans, lambda s: s["end"] - s["start"] >= rule.least)


def findings(docs: DataFrame, rules: Sequence[Rule] = RULES, bucket_texts: int = BUCKET_TEXTS) -> DataFrame:
    """(doc_id, text, found): every document with the spans of all rules, one array per rule."""
    postings = store(index(docs, asked_trigrams(rules), bucket_texts), "postings")
    chosen = store(candidates(postings, rules), "candidates")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("id", text_key(F.col("text")))
    joined = texts.join(chosen, "id", "left")
    none = F.array().cast("array<struct<start: bigint, place: int, kind: string, end: bigint>>")
    columns = []
    for k, rule in enumerate(rules):
        candidate = F.coalesce(F.col("rules").bitwiseAND(F.lit(1 << k)) != 0, F.lit(False)) if trigram_query(rule.pattern) else F.lit(True)
        matched = candidate & F.col("text").rlike(rule.pattern)
        columns.append(F.when(matched, spans(F.col("text"), rule, k)).otherwise(none).alias(rule.kind))
    return joined.select("doc_id", "text", *columns)


def _listed(kinds: Sequence[str]) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    ordered = F.sort_array(F.concat(*kinds)) if len(kinds) > 1 else F.sort_array(kinds[0])
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def query(docs: DataFrame, rules: Sequence[Rule] = RULES, bucket_texts: int = BUCKET_TEXTS) -> DataFrame:
    base = [rule.kind for rule in BASE]
    return findings(docs, rules, bucket_texts).select(
        "doc_id",
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in base],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed([rule.kind for rule in rules]).alias("spans"),
    )
