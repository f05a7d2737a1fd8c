"""Conversation repair against an exhaustive search of edits."""

import hashlib
import random
import re
import zlib

import pytest

from sluicebox.llm import repair
from tests.llm.conftest import by_row

SCHEMA = "conv_id bigint, turn bigint, role string, text string, hot string, block string, copies string, again string"


def best_edits(rows):
    """(cost, audit, lines) of the cheapest, then least edits, by a table of all rows and role texts read so far."""
    grow = {("", "user"): 2, ("s", "user"): 2, ("u", "assistant"): 3, ("a", "user"): 2}
    after = {"user": "u", "assistant": "a"}
    best = {"": (0, "", ())}

    def better(table, state, found):
        if state not in table or found[:2] < table[state][:2]:
            table[state] = found

    def opened(table):
        out = dict(table)
        for _ in range(3):
            for state, (cost, audit, lines) in list(out.items()):
                for role, letter in after.items():
                    if (state, role) in grow:
                        better(out, letter, (cost + 5, audit + "I", (*lines, f"{role}:")))
        return out

    for role, text, must_go, short in rows:
        table = {}
        for state, (cost, audit, lines) in opened(best).items():
            better(table, state, (cost + 2, audit + "D", lines))
            if must_go:
                continue
            more = 5 if short else 0
            for new, letter in after.items():
                if (state, new) in grow:
                    better(table, letter, (cost + 1 + more, audit + "R", (*lines, f"{new}:{text}")))
            first = role[:1]
            legal = first == "s" and state == "" or first == "u" and state != "u" or first == "a" and state == "u"
            if legal:
                better(table, first, (cost + more, audit + "K", (*lines, f"{role}:{text}")))
        best = table
    table = opened(best)
    return min(table[s] for s in ("", "a") if s in table)


def plain(rows):
    """rows: (conv_id, turn, role, text) before the damage."""
    told = lambda x: " " if x is None else x
    groups = {}
    for conv, turn, role, text in rows:
        mine = groups.setdefault(conv, [])
        harm = zlib.crc32(f"{told(conv)}:{told(turn)}".encode()) % 20
        role, text = told(role), told(text)
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        mine += [(turn, "user" if harm == 4 else role, text)] * {0: 0, 3: 2}.get(harm, 1)
    out = []
    for conv, mine in groups.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in mine:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        turns = {t for t, _, _ in mine if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, lines = best_edits(judged)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, digest))
    return by_row(out)


def table(ready, rows):
    return ready.createDataFrame([(*row, "x", "x", "x", "x") for row in rows], SCHEMA)


@pytest.fixture(scope="module")
def talks():
    dice = random.Random(11)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No", "Why?", "", " \n", None, "Good! ", "half a", "é…", "Fine."]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(dice.randrange(12)):
            rows.append((conv, None if dice.random() < 0.1 else turn + dice.randrange(3), dice.choice(roles), dice.choice(texts) if dice.random() < 0.6 else f"text {turn}."))
    rows += [(61, k // 2, roles[k % 5], texts[k % 7]) for k in range(300)]  # one long conversation
    rows += [(62, 7, "user", "Same.")] * 150 + [(62, k, "assistant", f"reply {k}.") for k in range(5)]
    rows += [(63, 0, "user", "x" * 5000 + ".")] * 3 + [(64, None, None, None)]
    return rows


def test_repair_of_conversations(ready, talks):
    assert by_row(repair.query(table(ready, talks).repartition(5)).collect()) == plain(talks)


@pytest.mark.parametrize("block_rows, fan", [(10, 2), (37, 3), (4, 512)])
def test_long_conversations_are_repaired_in_blocks(ready, talks, block_rows, fan):
    assert by_row(repair.query(table(ready, talks), block_rows, fan=fan).collect()) == plain(talks)


def test_long_null_conversation_and_large_texts(ready, talks):
    rows = [(None if conv == 61 else conv, *rest) for conv, *rest in talks]
    assert by_row(repair.query(table(ready, rows), 50).collect()) == plain(rows)
    assert by_row(repair.query(table(ready, rows), block_bytes=4000).collect()) == plain(rows)


def test_repair_of_nothing(ready):
    assert repair.query(table(ready, [])).collect() == []


def test_halving_finds_the_least_of_the_cheapest_audits():
    dice = random.Random(2)
    for _ in range(400):
        codes = "".join(dice.choice("suaoSUAOx") for _ in range(dice.randrange(14)))
        full = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
        rows = [(full.get(c.lower(), "user"), str(k), c == "x", c.isupper()) for k, c in enumerate(codes)]
        cost, audit, lines = best_edits(rows)
        assert repair.repair(codes) == (cost, audit)
        assert tuple(repair.repaired_lines([r[:2] for r in rows], audit)) == lines


def test_pieces_of_a_block_give_the_same_text(ready, talks, monkeypatch):
    rows = [(k // 30, "user" if k % 2 else "assistant", f"text {k}.", 1 + (k == 5), False) for k in range(60)]
    items, weights, kept, _ = repair._block_items(rows)
    cost, state, inserts = repair.best_end(repair.matrix_of(items))
    for size in (1, 50, 1 << 20):
        monkeypatch.setattr(repair, "PIECE_BYTES", size)
        pieces = list(repair._repaired_block((0, 0), [(*row, 0, state) for row in rows]))
        text = b"\n".join(p[2] for p in pieces if p[2] is not None).decode()
        doubled = [kept[i] for i, row in enumerate(rows) for _ in range(row[3])]
        audit = "".join(p[1] for p in pieces)
        assert text == "\n".join(repair.repaired_lines(doubled, audit))
