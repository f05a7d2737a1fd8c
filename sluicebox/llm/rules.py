"""Quality rules: lines are judged first, then texts by how much of them is left. DataFrame functions only.

A line with words fails if it is navigation (short parts between bars or arrows), boilerplate (fixed phrases), without any
letter, rich in symbols, mostly digits, or a repetition of an earlier line. Lines that fail are removed; a text stays if its
words pass the base figures, enough of its words are left, and enough of the lines left, if these are not few, end like sentences.

Defined results: null counts as empty text; texts without words fail the base figures; blank lines are kept out of all
line figures; repeated rows get equal results. Only doc_id and text are read, so other columns may have any name.
Repeated five-word windows are told apart by 64-bit hashes of their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_LOST_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MAX_DIGIT_PERCENT = 50
MIN_PROSE_PERCENT = 10
PROSE_LINES = 3  # fewer lines say nothing about how a text's lines end
SYMBOLS = r"[#*$%&|<>{}=~^_@+/\\]"
MAX_FURNITURE_CHARS = 200
#: Phrases of page furniture.
BOILERPLATE = (
    r"cookie policy|privacy policy|terms of (use|service)|all rights reserved|click here|sign up|log ?in|subscribe|"
    r"newsletter|javascript|share this|read more|follow us|skip to content|back to top|licensed under|copyright"
)
SENTENCE_ENDS = (".", "!", "?", "\"", "”", "»", ")")
SEPARATORS = r"[|»›>]"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def _size(array: Column) -> Column:
    return F.size(array).cast("bigint")


def _after(array: Column, steps: int = 1) -> Column:
    return F.slice(array, steps + 1, F.greatest(F.size(array), F.lit(1)))


def _count(text: Column, symbols: str) -> Column:
    """How many characters of a regular character class a text has."""
    return (F.size(F.split(text, symbols)) - 1).cast("bigint")


def _covered(starts: Column) -> Column:
    """Words inside the windows that begin at the given ascending starts."""
    gaps = F.zip_with(starts, _after(starts), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap)


def _repeated_starts(windows: Column) -> Column:
    """Starts, ascending, of the windows whose hash occurs twice or more; ``windows`` is sorted by (hash, start)."""
    twins = F.zip_with(windows, _after(windows), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda pair: pair.isNotNull()))))


def base_figures(docs: DataFrame) -> DataFrame:
    """(doc_id, text, lines, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed) per document.

    Each array is a column of its own before a lambda uses it, so that it is made once per text. Windows are sorted only
    in texts in which two hashes are equal at all.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select("doc_id", text.alias("text")).withColumn("words", words_of(F.col("text"))).withColumn("lines", lines)
    rows = rows.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("h2", F.zip_with("h1", _after(F.col("h1")), lambda a, b: F.xxhash64(a, b)))
    rows = rows.withColumn("h4", F.zip_with("h2", _after(F.col("h2"), 2), lambda a, b: F.xxhash64(a, b)))
    rows = rows.withColumn("h5", F.zip_with("h4", _after(F.col("h1"), 4), lambda a, b: F.xxhash64(a, b)))
    rows = rows.withColumn("h5", F.slice("h5", 1, F.greatest(F.size("h5") - (WINDOW - 1), F.lit(0))))
    repeats = F.size(F.array_distinct("h5")) < F.size("h5")
    placed = F.sort_array(F.transform("h5", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("windows", F.when(repeats, placed)).withColumn("starts", _repeated_starts(F.col("windows")))
    rows = rows.select(
        "doc_id",
        "text",
        "lines",
        _size(F.col("words")).alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        _count(F.col("text"), r"[#*$%&|<>]").alias("n_symbols"),
        (_size(F.col("lines")) - _size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.coalesce(_covered(F.col("starts")), F.lit(0).cast("bigint")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def line_fails(line: Column) -> Column:
    """Whether a line with words is navigation, boilerplate, letterless, rich in symbols or mostly digits."""
    furniture = (F.char_length(line) < MAX_FURNITURE_CHARS) & F.lower(line).rlike(BOILERPLATE)
    odd = 100 * _count(line, SYMBOLS) > MAX_SYMBOL_PERCENT * F.char_length(line)
    odd = odd | (100 * _count(line, "[0-9]") > MAX_DIGIT_PERCENT * F.char_length(line))
    return (_count(line, SEPARATORS) >= 2) | ~line.rlike(r"\p{L}") | furniture | odd


def clean(docs: DataFrame) -> DataFrame:
    """The base figures with kept_lines (distinct lines that pass, in order), clean_text, n_kept_words and kept."""
    rows = base_figures(docs)
    rows = rows.withColumn("kept_lines", F.filter(F.array_distinct("lines"), lambda line: ~line_fails(line)))
    rows = rows.withColumn("clean_text", F.array_join("kept_lines", "\n"))
    whole = F.size("kept_lines") == F.size("lines")
    rows = rows.withColumn("n_kept_words", F.when(whole, F.col("n_words")).otherwise(_size(words_of(F.col("clean_text")))))
    prose = _size(F.filter("kept_lines", lambda line: F.substring(F.rtrim(line), -1, 1).isin(*SENTENCE_ENDS)))
    enough = 100 * (F.col("n_words") - F.col("n_kept_words")) <= MAX_LOST_PERCENT * F.col("n_words")
    few = F.size("kept_lines") < PROSE_LINES
    verdict = ~F.col("base_failed") & enough & (few | (100 * prose >= MIN_PROSE_PERCENT * F.size("kept_lines")))
    return rows.withColumn("kept", verdict).drop("lines")


def query(docs: DataFrame) -> DataFrame:
    return clean(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_kept_words"
    )
