"""Operators with an exact result, against plain Python."""

import collections
import hashlib
import re

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluicebox.llm import decontamination, graph, jaccard, pieces, private, repeats, rules, tokens
from tests.llm.conftest import by_row

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# --- op1


def plain_repeats(pairs, length=repeats.LENGTH):
    raws = [(i, (t or "").encode()) for i, t in pairs]
    seen = collections.Counter(raw[k : k + length] for _, raw in raws for k in range(len(raw) - length + 1))
    out = []
    for i, raw in raws:
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if seen[raw[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return by_row(out)


@pytest.mark.parametrize("limit", [2, 2000])
def test_repeats_of_awkward_texts(awkward, limit):
    assert by_row(repeats.query(awkward, limit).collect()) == plain_repeats(pairs_of(awkward))


def test_repeats_of_documents(documents):
    assert by_row(repeats.query(documents).collect()) == plain_repeats(pairs_of(documents))


def test_repeats_of_nothing(empty):
    assert repeats.query(empty).collect() == []


def test_kept_text_is_what_the_digest_says(awkward):
    for row in repeats.deduplicated(awkward).where("doc_id not in (10)").collect():
        assert hashlib.sha256(row["kept_text"].encode()).hexdigest() == row["kept_sha256"]


def test_large_groups_go_on_in_small_batches():
    dice = np.random.default_rng(8)
    passage = bytes(dice.integers(97, 123, 380))
    # all windows that hold the passage: 20 distances from the anchor, the first two documents have equal ones
    left = [bytes(dice.integers(97, 123, 300)) for _ in range(3000)]
    left[1] = left[0]
    strings = sorted((passage + bytes([97 + i % 20]) * 20 + own, i, 300, 301) for i, own in enumerate(left))

    class Taken:
        def repartitionById(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    def merged(limit):
        shared, lengths, rest = repeats.front_coded([s[0] for s in strings])
        data = shared.astype(np.uint32).tobytes() + lengths.tobytes() + np.array([s[1:] for s in strings], np.int64).tobytes() + rest
        packed = repeats.zstandard.ZstdCompressor().compress(data)
        columns = {"range": [0], "run": [0], "n": [len(strings)], "data": [packed]}
        batches = list(repeats._merged(Taken(), 1, limit)([pa.RecordBatch.from_pydict(columns)]))
        assert max(b.num_rows for b in batches) <= 20_000
        return pa.Table.from_batches(batches).to_pylist()

    rows = merged(100_000)
    windows = collections.Counter(r["digest"] for r in rows)
    assert len(rows) > 100_000 and all(r["bits"] is None for r in rows)
    digests = {(r["content"], r["number"]) for r in rows if windows[r["digest"]] > 1}
    small = {r["content"]: np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in merged(10_000_000)}
    assert digests == {(content, int(number)) for content, bits in small.items() for number in np.flatnonzero(bits)} != set()


def test_loser_tree_merges_front_coded_runs():
    dice = np.random.default_rng(3)
    for _ in range(200):
        runs = [sorted(bytes(dice.integers(97, 99, dice.integers(0, 9))) for _ in range(dice.integers(0, 8))) for _ in range(dice.integers(1, 6))]
        coded = [repeats.Run(*repeats.front_coded(run), [None] * len(run)) for run in runs]
        out, shared = [], []
        for run, n in repeats.LoserTree(coded):
            out.append(run.string)
            shared.append(n)
        assert out == sorted(s for run in runs for s in run)
        assert shared == [repeats.common_prefix(a, b) for a, b in zip([b"", *out], out)]


def test_every_window_has_one_unit_and_its_anchor():
    data = np.random.default_rng(1).integers(0, 3, 3000).astype(np.uint8)
    anchors, borders = repeats.units(data)
    hashes = repeats.gram_hashes(data) >> repeats.PLACE_BITS
    for k in range(len(anchors)):
        for start in range(borders[k], borders[k + 1]):
            assert anchors[k] == start + hashes[start : start + repeats.WINDOWS].argmin()
    assert borders[0] == 0 and borders[-1] == len(data) - repeats.LENGTH + 1


@pytest.mark.parametrize("size, piece", [(3000, 700), (3000, 1), (399, 700), ((1 << 26) + 3000, None)])
def test_units_of_texts_in_pieces(size, piece, monkeypatch):
    data = np.random.default_rng(2).integers(0, 3, size, dtype=np.uint8)
    whole = repeats.units(data) if piece else None
    if piece:
        monkeypatch.setattr(repeats, "PIECE", piece)
    anchors, borders = repeats.units(data)
    if whole:
        assert np.array_equal(anchors, whole[0]) and np.array_equal(borders, whole[1])
    assert borders[-1] == max(0, size - repeats.LENGTH + 1)
    assert (anchors >= borders[1:] - 1).all() and (anchors < borders[:-1] + repeats.WINDOWS).all()


# --- op2


def plain_figures(text):
    words = WORD.findall(text or "")
    windows = collections.Counter(zip(*[words[k:] for k in range(5)]))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    repeat = len(inside)
    failed = len(words) < 10 or 100 * repeat > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeat, failed


def test_rules_base_figures(awkward, documents):
    for docs in (awkward, documents):
        rows = rules.query(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
        assert by_row(rows) == by_row((i, *plain_figures(t)) for i, t in pairs_of(docs))


def test_rules_lines(ready):
    good = "The quick brown fox jumps over the lazy dog again."
    docs = ready.createDataFrame(
        [(1, "\n".join([good, "Home | News | Sport", "Read more", good, "#### $$$$ %%%% 1234"])), (2, "a | b | c\n" * 3 + good), (3, good)], "doc_id int, text string"
    )
    rows = {r["doc_id"]: r for r in rules.clean(docs).collect()}
    assert rows[1]["kept_lines"] == [good] and not rows[1]["kept"]
    assert rows[3]["kept"] and rows[3]["clean_text"] == good


def test_rules_of_nothing_and_without_python(empty):
    result = rules.query(empty)
    assert result.collect() == []
    plan = result._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# --- op3


def plain_hits(pairs, items, window=13):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    found = collections.defaultdict(set)
    for name, text in items:
        words = pattern.findall(lower(text))
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            found[tuple(words[k : k + size])].add(name)
    sizes = {len(w) for w in found}
    out = []
    for i, text in pairs:
        words, hit, names = pattern.findall(lower(text)), set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in found:
                    hit.update(range(k, k + size))
                    names |= found[tuple(words[k : k + size])]
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return by_row(out)


ITEMS = [("a", "one two"), ("b", "ONE"), ("c", None), ("d", "?!"), ("e", "a b c"), ("f", "b c"), ("g", "one two")]


def test_hits_in_documents(documents, ready, data):
    items = ready.read.parquet(f"{data}/benchmark.parquet")
    named = [(str(r["item_id"]), r["text"]) for r in items.collect()]
    assert by_row(decontamination.query(documents, items).collect()) == plain_hits(pairs_of(documents), named)


@pytest.mark.parametrize("block", [decontamination.BLOCK_CHARS, 5])
def test_hits_of_short_items_and_many_blocks(awkward, awkward_rows, ready, block, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", block)
    long_item = ("z", " ".join(awkward_rows[3][1].split()[20:50]))
    items = ready.createDataFrame([(*i, "clash") for i in [*ITEMS, long_item]], "item_id string, text string, n_words string")
    assert by_row(decontamination.query(awkward, items).collect()) == plain_hits(pairs_of(awkward), [*ITEMS, long_item])
    kept = decontamination.stage(awkward, items)
    verdict = {r[0]: r[5] for r in plain_hits(pairs_of(awkward), [*ITEMS, long_item])}
    assert kept.columns == awkward.columns
    assert {r["doc_id"] for r in kept.collect() if r["doc_id"]} == {i for i, bad in verdict.items() if i and not bad}


def test_hits_without_items_or_documents(awkward, empty, ready):
    none = ready.createDataFrame([], "item_id int, text string")
    assert not decontamination.query(awkward, none).where("n_hit > 0 or contaminated").collect()
    assert decontamination.query(empty, none).collect() == []
    assert by_row((r["doc_id"], r["text"]) for r in decontamination.stage(awkward, none).collect()) == by_row(pairs_of(awkward))


@pytest.mark.parametrize("block", [decontamination.BLOCK_CHARS, 5])
def test_stage_cleans_each_text_once(awkward, ready, block, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", block)
    plan = decontamination.stage(awkward, ready.createDataFrame(ITEMS, "item_id string, text string"))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("ArrowEvalPython") == 1


def test_spans_are_cut_by_words():
    assert decontamination.without_spans("Ab, cd ef. gh!", [1], [3]) == "Ab, . gh!"


# --- op4


@pytest.fixture(scope="module")
def piece_file():
    return pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))


def unigram(content):
    """The same pieces with other scores as a model of the other kind; all sums of scores are exact."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(content)
    proto.trainer_spec.model_type = 1
    for at, piece in enumerate(proto.pieces):
        if piece.type == 1:
            piece.score = -40.0 + 2 * len(piece.piece) + (at * 7919 % 64) / 8
    return proto.SerializeToString()


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_ids_equal_the_library(piece_file, documents, awkward_rows, kind):
    import sentencepiece

    content = piece_file if kind == "bpe" else unigram(piece_file)
    library, own = sentencepiece.SentencePieceProcessor(model_proto=content), pieces.PieceModel(content)
    dice = np.random.default_rng(4)
    letters = list("  \n\tabcdefghinorstuAE.,!?0123 ééüñ漢字😀▁\x00tthhh")
    texts = ["".join(dice.choice(letters, dice.integers(0, 60))) for _ in range(1500)]
    texts += [t for _, t in pairs_of(documents)] + [r[1] for r in awkward_rows if r[1] and len(r[1]) < 20000]
    for text in texts:
        assert own.encode(text) == library.encode(text), text[:200]
        assert own.decode(own.encode(text)) == text.replace("▁", " ")


def test_encode_and_decode_tables(awkward, empty, piece_file):
    coded = pieces.encode(awkward, piece_file)
    assert coded.where("not round_trip").collect() == []
    texts = by_row((r["doc_id"], r["text"]) for r in pieces.decode(coded, piece_file).collect())
    assert texts == by_row((i, (t or "").replace("▁", " ")) for i, t in pairs_of(awkward))
    assert pieces.encode(empty, piece_file).collect() == []


# --- op5


def shingle_set(text):
    words = WORD.findall(lower(text))
    return frozenset(zip(*[words[k:] for k in range(5)])) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def plain_components(pairs):
    sets = [(i, shingle_set(t)) for i, t in pairs]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for a, (i, s) in enumerate(sets):
        ids = [j for b, (j, _) in enumerate(sets) if root(b) == root(a) and j is not None]
        least[a] = (i, len(s), min(ids, default=None) if s else i)
    return by_row(least.values())


def test_components_of_texts(awkward, documents, empty):
    for docs in (awkward, documents):
        assert by_row(jaccard.query(docs).collect()) == plain_components(pairs_of(docs))
    assert jaccard.query(empty).collect() == []


@pytest.mark.parametrize("cell_sets", [2_000, 7])
def test_chains_and_hot_passages(ready, cell_sets, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL_SETS", cell_sets)
    dice = np.random.default_rng(9)
    passage = [f"p{k}" for k in range(50)]
    rows, text = [], [f"w{k}" for k in range(120)]
    for i in range(60):  # each is near the one before, the last is far from the first
        text = list(text)
        text[dice.integers(0, 120)] = f"x{i}"
        rows.append((i, " ".join(text)))
    for i in range(60, 150):  # unrelated texts that share a long passage
        rows.append((i, " ".join([*(f"d{i}_{k}" for k in range(70)), *passage])))
    docs = ready.createDataFrame(rows, "doc_id int, text string")
    assert by_row(jaccard.query(docs).collect()) == plain_components(rows)
    assert sorted(r["doc_id"] for r in jaccard.stage(docs).collect()) == sorted({r[2] for r in plain_components(rows)})


def test_hot_passages_make_no_pairs():
    """3,000 texts share two thirds of their shingles and nothing else; a few among them are near each other."""
    dice = np.random.default_rng(4)
    shared = np.arange(100, dtype=np.uint64) * np.uint64(77)
    own = dice.integers(0, 2**63, (3000, 50)).astype(np.uint64)
    own[5, :40] = own[2990, :40]
    own[6, :20] = own[2991, :20]
    sets = [np.unique(np.concatenate([shared, mine])) for mine in own]
    n = np.array([len(s) for s in sets])
    alone = np.full(3000, 50)
    alone[[5, 2990]], alone[[6, 2991]] = 10, 30
    names, side = np.arange(3000), np.ones(3000, dtype=int)
    pairs = list(jaccard.close_in_cell(names, n, alone, names, side, [jaccard.parity_bits(s) for s in sets]))
    assert (5, 2990) in pairs and len(pairs) < 10
    without_counts = set(jaccard.close_in_cell(names[:400], n[:400], alone[:400] * 0, names[:400], side[:400], [jaccard.parity_bits(s) for s in sets[:400]]))
    plain = {
        (a, b)
        for b in range(400)
        for a in range(b)
        if jaccard.distance(jaccard.parity_bits(sets[a]), jaccard.parity_bits(sets[b])) <= jaccard.differs_at_most(n[a], n[b])
    }
    assert without_counts == plain


@pytest.mark.parametrize("exact_sets", [jaccard.EXACT_SETS, 7])
def test_close_sets_of_one_part_make_a_forest(ready, exact_sets, monkeypatch):
    """Texts with two changed words of 60: many pairs are linked, others only close by bits; forests become rows, not pairs."""
    monkeypatch.setattr(jaccard, "EXACT_SETS", exact_sets)
    dice = np.random.default_rng(11)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        at = dice.integers(10, 45)
        words[at] = words[at + dice.integers(0, 6)] = f"x{i}"
        rows.append((i, " ".join(words)))
    docs = ready.createDataFrame(rows, "doc_id bigint, text string").cache()
    described = jaccard.describe(docs)
    sets = described.groupBy("name").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.min("n").alias("n"), F.min("bits").alias("bits")
    ).cache()
    kept = sets.select(F.lit(1).cast("bigint").alias("key"), "name", "n", F.lit(0).cast("bigint").alias("own"), F.col("name").alias("component")).cache()
    shingles = {jaccard.set_name(found): found for found in map(jaccard.Shingler(), dict(rows).values())}
    names = sorted(shingles)
    linked = [(a, b) for k, a in enumerate(names) for b in names[k + 1 :] if jaccard.linked(shingles[a], shingles[b])]
    forest = jaccard._close_forest(kept, sets).collect()
    assert 0 < len(forest) < len(names) < len(linked)

    def groups(pairs):
        trees = jaccard.Forest()
        for a, b in pairs:
            trees.join(a, b)
        return {name: trees.root(name) for name in names}

    links = [tuple(r) for r in jaccard._across(docs, kept, sets).collect()]
    assert set(links) <= set(linked) and groups(links) == groups(linked)


def rows_exchanged(df, column):
    """Rows of the executed plan that shuffles with this column moved."""
    plans, total = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        kind, children = plan.getClass().getSimpleName(), plan.children()
        plans += [children.apply(k) for k in range(children.size())]
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        elif kind == "ShuffleExchangeExec" and f"{column}#" in plan.output().toString():
            total += plan.metrics().apply("shuffleRecordsWritten").value()
    return total


def test_only_texts_in_question_are_shuffled(ready):
    """Of 1,000 texts, two near ones and one without an id are compared; joins of large tables do not move the others."""
    near = [f"w{k}" for k in range(80)]
    rows = [(i, " ".join(f"d{i}_{k}" for k in range(20))) for i in range(1000)]
    rows += [(1000, " ".join(near)), (1001, " ".join([*near[:79], "x"])), (None, " ".join(["y", *near[1:]]))]
    docs = ready.createDataFrame(rows, "doc_id int, text string")
    described = jaccard.describe(docs)
    sets = described.groupBy("name").agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.min("n").alias("n")).cache()
    a, b, c = (jaccard.set_name(jaccard.Shingler()(t)) for _, t in rows[1000:])
    pairs = ready.createDataFrame([(a, b), (a, c)], "a bigint, b bigint")
    least = ready.conf.get("spark.sql.autoBroadcastJoinThreshold")
    ready.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = jaccard._verified(docs, sets, pairs)
        assert by_row(links.collect()) == by_row([(a, b), (a, c)])
        assert 3 <= rows_exchanged(links, "text") <= 200
    finally:
        ready.conf.set("spark.sql.autoBroadcastJoinThreshold", least)


@pytest.mark.parametrize("sort_parts", [600_000, 1, 100])
def test_shared_parts_of_large_buckets(ready, sort_parts, monkeypatch):
    """Buckets are sorted in shares; copies in other tasks are one set."""
    monkeypatch.setattr(jaccard, "SORT_PARTS", sort_parts)
    texts = [" ".join(f"{'w' if k < 40 else f't{i % 7}_'}{k}" for k in range(60)) for i in range(14)] + [" ".join(f"z{k}" for k in range(30))]
    docs = ready.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    sets = {jaccard.set_name(s): s for s in map(jaccard.Shingler(), texts)}
    found = {r["name"]: r for r in jaccard._shared_parts(jaccard._packed_parts(docs, 2), 2).collect()}
    parts = {name + k: jaccard.parts(s, band) for name, s in sets.items() for k, band in enumerate(jaccard.bands(len(s)))}
    counts = collections.Counter(int(p) for own in parts.values() for p in own)
    expected = {name: sum(counts[int(p)] > 1 for p in own) for name, own in parts.items()}
    assert {name: r["n_shared"] for name, r in found.items()} == {name: n for name, n in expected.items() if n}
    for name, row in found.items():
        keys = [int(k) for k in np.frombuffer(row["keys"], np.uint64)]
        assert sorted(keys) == sorted(((int(p) >> 32) * 2 >> 32 << 32) | (int(p) & 0xFFFFFFFF) for p in parts[name] if counts[int(p)] > 1)


@pytest.mark.parametrize("n", [1, 5, 48, 63, 64, 100, 255, 256, 800, 5000, 70_000])
def test_parts_are_counted_without_their_hashes(n):
    shingles = np.unique(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    assert all(jaccard.count_parts(shingles, band) == len(jaccard.parts(shingles, band)) for band in jaccard.bands(n))


def test_stage_keeps_one_row_of_a_component(awkward, awkward_rows, ready):
    def left(rows, schema="doc_id int, text string, source string"):
        return by_row(tuple(r) for r in jaccard.stage(ready.createDataFrame(rows, schema).repartition(3)).collect())

    blank = [r for r in awkward_rows if not shingle_set(r[1])]
    sets = [(r[0], shingle_set(r[1])) for r in awkward_rows]
    kept = jaccard.stage(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    firsts = {r[2] for r in plain_components([(r[0], r[1]) for r in awkward_rows if shingle_set(r[1])])}
    assert sorted(i for i in ids if i is not None) == sorted([r[0] for r in blank if r[0] is not None] + list(firsts))
    assert ids.count(4) == 1 and ids.count(None) == 1 and len(sets) > len(ids)  # the null id that stays has no text

    a, b, c = (" ".join(f"{letter}{k}" for k in range(30)) for letter in "abc")
    assert left([(5, a, "x")] * 6) == [(5, a, "x")]
    assert left([(2, a, "x"), (2, b, "x"), (1, a, "x")]) == [(1, a, "x"), (2, b, "x")]
    assert left([(None, c, "x")] * 4 + [(None, a, "x"), (3, a, "x"), (None, None, "x")]) == by_row([(None, c, "x"), (3, a, "x"), (None, None, "x")])
    assert len(left([(7, a, "x"), (7, a, "y"), (7, a, None)])) == 1


def test_sketches_bound_the_difference():
    dice = np.random.default_rng(2)
    for n in (3, 40, 300, 2000, 9000):
        a = np.unique(dice.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(n * 0.9)], dice.integers(0, 2**63, n // 10 + 1).astype(np.uint64)]))
        apart = len(np.setxor1d(a, b))
        assert jaccard.distance(jaccard.parity_bits(a), jaccard.parity_bits(b)) <= apart
        for band in set(jaccard.bands(len(a))) & set(jaccard.bands(len(b))):
            assert len(np.setdiff1d(jaccard.parts(a, band), jaccard.parts(b, band))) <= apart


def test_components_of_a_graph(ready):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (4, 6), (10, 3)]
    found = dict(map(tuple, graph.components(ready.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert found == {1: 1, 2: 1, 3: 1, 10: 1, 4: 4, 5: 4, 6: 4}


# --- op6


def test_token_counts_equal_the_library(awkward, documents, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        content = file.read()

    def row(i, t):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        return i, len((t or "").encode()), n, n > 2048

    for docs in (awkward, documents):
        assert by_row(tokens.query(docs, content).collect()) == by_row(row(i, t) for i, t in pairs_of(docs))
    assert tokens.query(empty, content).collect() == []


# --- op7

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def plain_base(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in private.IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in private.CARD.finditer(text):
        d = digits(m.group())
        total = sum(x if k % 2 == 0 else 2 * x - 9 * (x > 4) for k, x in enumerate(map(int, reversed(d))))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in private.PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]


def test_base_spans(awkward, documents, empty):
    for docs in (awkward, documents):
        rows = private.query(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256").collect()
        expected = []
        for i, t in pairs_of(docs):
            spans = plain_base(t)
            kinds = collections.Counter(s[0] for s in spans)
            digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
            expected.append((i, *(kinds[k] for k in ("email", "ip", "card", "phone")), digest))
        assert by_row(rows) == by_row(expected)
    assert private.query(empty).collect() == []


def test_addresses_equal_the_pattern():
    dice = np.random.default_rng(6)
    for _ in range(20_000):
        text = "".join(dice.choice(list("ab.@@- 1_é"), dice.integers(0, 25)))
        assert private.emails(text) == [m.span() for m in EMAIL.finditer(text)]


def test_patterns_discover_identifiers(ready):
    rows = [(k, f"some words here kontakt user{k}@mail.example.org more words") for k in range(30)]
    rows += [(40, "please ask kontakt jd4711 today"), (41, "version 41 of the thing"), (42, "kontakt: none")]
    found = {r["doc_id"]: r["spans"] for r in private.query(ready.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert found[40] == "id:19:25" and found[41] == "" and found[42] == ""
    masked = {r["doc_id"]: r["text"] for r in private.stage(ready.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert masked[40] == "please ask kontakt [ID] today" and masked[41] == rows[31][1]
    assert masked[0] == "some words here kontakt [EMAIL] more words"


# --- the same results in SQL


@pytest.mark.parametrize("name", ["op1_suffix_dedup", "op2_quality_rules", "op3_decontamination", "op5_jaccard_join"])
def test_sql_gives_the_same_rows(ready, data, name):
    from sluicebox.llm import registry

    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    expected = connection.sql(registry.oracle_sql()[name])
    found = registry.queries()[name](ready, data)
    assert sorted(found.columns) == sorted(expected.columns)
    assert by_row(found.select(*expected.columns).collect()) == by_row(expected.fetchall())


def test_pipeline_runs_every_stage(ready, data):
    import corpus_pipeline

    docs = ready.read.parquet(f"{data}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(ready, docs, data).cache()
        assert docs.columns == columns and 0 < docs.count() <= before, name
        before = docs.count()
    last = corpus_pipeline.run(ready, data)
    assert last.count() == before and last.where("not round_trip").count() == 0
