"""Operators that learn: held-out accuracy, and defined results for awkward input."""

import random

import numpy as np
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType

from sluicebox.llm import language, quality, toxicity
from tests.llm.conftest import by_row

SYLLABLES = {"en": "th er on an re he in ed nd ha", "fr": "eu ai ou on é è ê qu oi tr", "de": "sch ei en er ß ü ö ch au zu"}


def talk(dice, lang, n):
    return " ".join("".join(dice.choice(SYLLABLES[lang].split()) for _ in range(dice.randint(1, 4))) for _ in range(n))


def corpus(ready, n=420):
    dice, rows, labels = random.Random(8), [], []
    for i in range(n):
        lang = dice.choice(list(SYLLABLES))
        words = talk(dice, lang, dice.randint(30, 80)).split()
        toxic = i % 5 == 0
        if toxic:
            for term in dice.sample(["wretch", "vermin", "scoundrel", "imbecile"], 3):
                words.insert(dice.randrange(len(words)), term)
        poor = i % 4 == 1
        text = " ".join(words)
        rows.append((i, "### $$$ " * 20 + text.upper() if poor else text, lang))
        labels.append((i, 0 if poor else 1, int(toxic)))
    return ready.createDataFrame(rows, "doc_id int, text string, lang string"), ready.createDataFrame(labels, "doc_id int, quality int, toxic int")


def right(result, labels, column):
    rows = result.join(labels, "doc_id").where("held_out").select((F.col("predicted") == F.col(column)).cast("int").alias("ok")).collect()
    return sum(r["ok"] for r in rows) / len(rows)


def test_held_out_accuracy(ready):
    docs, labels = corpus(ready)
    assert right(toxicity.query(docs, labels), labels, "toxic") >= 0.97
    assert right(quality.query(docs, labels), labels, "quality") >= 0.97
    found = language.query(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()


def test_labels_and_languages_are_no_inputs(ready):
    docs, labels = corpus(ready, 120)
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert by_row(quality.query(docs, labels).collect()) == by_row(quality.query(docs, other).collect())
    hidden = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1, F.col("lang")))
    assert by_row(language.query(docs).collect()) == by_row(language.query(hidden).collect())


def test_awkward_texts_get_scores(awkward, empty, ready):
    docs, labels = corpus(ready, 120)
    extra = labels.unionByName(ready.createDataFrame([(None, 1, 1), (4, None, None), (7, 1, 0), (7, 0, 1)], "doc_id int, quality int, toxic int"))
    for result in (toxicity.query(awkward, extra), quality.query(awkward, extra)):
        rows = result.collect()
        assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    assert toxicity.query(empty, labels).collect() == [] and quality.query(empty, labels).collect() == []
    none = labels.where("false")
    assert {r["predicted"] for r in toxicity.query(awkward, none).collect()} == {0}
    assert {r["score"] for r in quality.query(awkward, none).collect()} == {0.5}
    found = {r["doc_id"]: r for r in language.query(awkward).collect()}
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (1, 2, 3))
    assert language.query(empty).collect() == []
    assert {r["lang_pred"] for r in language.query(awkward.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_stage_keeps_columns_and_clean_documents(ready):
    docs, labels = corpus(ready)
    kept = toxicity.stage(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] % 5 == 0 for r in kept.select("doc_id").collect()} == {False}
    assert kept.count() == docs.where("doc_id % 5 <> 0").count()


def test_stage_reads_arrow_in_slices(ready):
    docs, labels = corpus(ready)
    many = docs.unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string"))).coalesce(1)
    kept = toxicity.stage(many, labels)
    assert "pythonUDF0#" in (plan := kept._jdf.queryExecution().executedPlan().toString())
    assert f"], {PythonEvalType.SQL_SCALAR_ARROW_UDF}" in plan  # not a batch of 10,000 texts as pandas strings
    assert kept.count() == docs.where("doc_id % 5 <> 0").count() + 1


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i] + [0] * len(b) if not (before := row) else [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automata_equal_edit_distance():
    dice = random.Random(1)
    terms = ["abcab", "bcaba", "cabcabcab", "ab", "bbbbbbbbbb", "abcba"]
    lexicon = toxicity.FuzzyLexicon(terms)
    for _ in range(20_000):
        word = "".join(dice.choice("abcx") for _ in range(dice.randint(1, 12)))
        near = [(d, t) for t in terms if t[0] == word[0] and (d := plain_distance(word[1:], t[1:])) <= toxicity.edits_for(t)]
        expected = (min(near)[1], min(near)[0]) if near else None
        assert lexicon.match(word) == expected, word


def test_quotation_and_abuse_are_apart():
    model = toxicity.ToxicityModel({"vermin": 2.0}, frozenset(), None)
    abuse, quote = model.evidence("you are vermin and always were"), model.evidence("he said 'vermin' is a word")
    assert abuse[0] > 0 and abuse[1] == 0 and quote[0] == 0 and quote[1] > 0
    assert model.evidence("such vermim people")[2] > 0


def test_rank_order():
    codes, counts = language.ngram_counts(language.marked_letters("Ab ab, a1B"))
    grams = {"".join(chr(int(c) >> 21 * k & 0x1FFFFF) for k in (2, 1, 0) if int(c) >> 21 * k): n for c, n in zip(codes, counts)}
    edge = chr(language.EDGE)
    assert grams["a"] == 3 and grams["b"] == 3 and grams["ab"] == 2 and grams[edge + "ab"] == 2 and grams["b" + edge] == 3
    assert edge not in grams
    many = np.array([5, 3, 9]), np.array([1, 2, 2])
    assert language.ranked(*many).tolist() == [3, 9, 5]


def test_pairs_find_what_single_features_cannot():
    dice = np.random.default_rng(0)
    x = dice.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.boost(x, y)
    assert (0, 1) in model.pairs
    assert ((model.scores(x) >= 0.5) == (y == 1)).mean() > 0.9
