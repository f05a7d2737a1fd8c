"""Filter interaction audit against plain Python."""

import itertools
import re

import numpy as np

from sluicebox.llm import removal
from tests.llm.conftest import by_row


def plain_audit(rows, labels):
    """rows: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    docs = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = [i for i, t, _ in rows if (t or "") == text and i is not None and doc_id is not None and i < doc_id]
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": bool(smaller),
        }
        good = any(q == 1 for i, q, _ in labels if doc_id is not None and i == doc_id)
        bad = any(t == 1 for i, _, t in labels if doc_id is not None and i == doc_id)
        docs.append((lang or "", {f for f, failed in fails.items() if failed}, good, bad))
    out = []
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        table, total = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = list(range(len(mine)))
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in mine[k][1]]
                redundant = sum(f in d[1] for k, d in enumerate(mine) if k not in left)
                left = [k for k in left if k not in gone]
                total[f] += len(gone)
                table.append((
                    part, "".join(order), step, len(left), len(gone), redundant, sum(d[1] == {f} for d in mine),
                    sum(mine[k][2] for k in gone), sum(mine[k][3] for k in gone), f,
                ))
        out += [(*row[:-1], total[row[-1]]) for row in table]
    return by_row(out)


def test_audit_of_awkward_texts(ready, awkward, awkward_rows):
    rows = [(i, text, lang) for i, text, lang, *_ in awkward_rows]
    labels = [(4, 1, None), (4, 0, 1), (5, 1, 1), (6, None, None), (None, 1, 1), (99, 1, 1), (8, 0, 0), (16, 1, 0)]
    table = ready.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert by_row(removal.query(awkward, table).collect()) == plain_audit(rows, labels)


def test_parts_copies_and_repeated_ids(ready):
    long = " ".join(f"w{k}" for k in range(250))
    texts = [
        (3, long, "en"), (3, long, "en"), (9, long, None), (4, long + " #", "de"), (None, long, ""), (1, None, "fr"), (2, "", "fr"),
        (5, "A B C", "fr"), (6, "word " * 300, "fr"), (7, "word " * 300, "en"), (2, "", "fr"), (8, "ÉÄ É |", None),
    ]
    docs = ready.createDataFrame(texts, "doc_id bigint, text string, lang string")
    none = ready.createDataFrame([], "doc_id bigint, quality int, toxic int, part string, mask int, good string")
    found = by_row(removal.query(docs.withColumn("mask", docs.lang), none).collect())
    assert found == plain_audit(texts, [])
    assert len(found) == 4 * 600  # null and '' are one part


def test_audit_of_nothing(ready, empty):
    labels = ready.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert removal.query(empty, labels).collect() == []


def test_min_plus_product_is_the_first_failing_place():
    names, places = removal.orders("ABCD")
    masks = np.arange(16)
    steps = removal.removal_steps(masks, places)
    for m, k in itertools.product(range(16), range(24)):
        failing = [names[k].index(f) + 1 for j, f in enumerate("ABCD") if m >> j & 1]
        assert steps[m, k] == min(failing, default=5)
