"""Conversation structure repair: the cheapest edits that make a conversation's roles read ``(s?(ua)+)?``.

A row is kept (0), given the other role (1, to user or assistant) or deleted (2; the only choice for blank and duplicate
rows); an empty user or assistant row may be inserted anywhere (5); truncated rows that stay cost 5 more. Four states are
enough to read the roles: nothing yet, after the system row, after a user row, after an assistant row. The letters of the
edits lead from each state to one state only, so an audit text says all.

Hirschberg's halving: costs forward from the first state and backward from the last one meet in the middle, the cheapest
crossing is taken, and both halves are solved alone; no table of all rows and states is kept. Forward costs carry, for each
state, the rank of its least audit. Audits up to one row hold equally many rows and end in a row's letter, so none is the
beginning of another and ranks settle ties for good: of equally cheap crossings the audit-least is taken.

Conversations up to BLOCK_ROWS rows and BLOCK_BYTES bytes are solved in one task each. Longer ones are cut into blocks by
ranges of (turn, role, text), after equal rows have been counted; every block becomes a matrix of costs and ranks, matrices
are combined FAN at a time up to one per conversation, and the same halving then gives the crossings from the top down to the
blocks, which are repaired side by side. What must see a long conversation whole is its SHA-256: one task hashes its repaired
text as it streams by, in pieces.

Order: by turn, null turns first; equal turns by role, then text. Defined results: null roles and texts read as one space
before the damage; an empty role, or one whose first letter is not s, u or a, cannot be kept; a null conv_id is a conversation
of its own; equal rows repeat each other and are duplicates; no conversations give no rows. A row's text may be of any
length; a whole audit is one text and so ends at 2 GB. Only conv_id, turn, role and text are read, so other columns may have
any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import store

BLOCK_ROWS = 20_000
BLOCK_BYTES = 64 << 20
FAN = 512
PIECE_BYTES = 1 << 20
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
CUT_SHORT = 5
NEVER = 1 << 60
STATES = range(4)
ENDS = (0, 3)
#: Where a role's first letter leads from each state; a missing entry means that the row cannot be kept.
READ = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
#: Where a row that is inserted or given another role leads from each state, and its role.
NEXT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
LEGAL = frozenset({"su", "ua", "au"})
_SOLID = re.compile(r"[^\x20\x09-\x0D]")
_BLANKS = " \t\n\x0b\x0c\r"

RESULT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
    "repaired_sha256 string"
)
RESULT_NAMES = [field.split()[0] for field in RESULT.split(", ")]


# --- states, costs, crossings


def step_matrix(code: str, weight: int = 1) -> tuple[list[list[int]], list[list[str]]]:
    """Costs and letters from each state to each for one row: inserts first, then the row's own edit.

    ``code`` is x for rows that must go (``weight`` of them), else the class of the role, in capitals if truncated; $ stands
    behind the last row, where only inserts remain.
    """
    cost, word = [[NEVER] * 4 for _ in STATES], [[""] * 4 for _ in STATES]
    for start in STATES:
        state = start
        for inserts in range(3):
            if inserts:
                state = NEXT[state][0]
            own = [("", state, 0)] if code == "$" else [("D", state, COSTS["D"] * weight)]
            if code not in "x$":
                more = CUT_SHORT if code.isupper() else 0
                own.append(("R", NEXT[state][0], COSTS["R"] + more))
                own += [("K", to, COSTS["K"] + more) for at, to in READ[code.lower()].items() if at == state]
            for letter, to, price in own:
                found = (inserts * COSTS["I"] + price, "I" * inserts + letter)
                if found < (cost[start][to], word[start][to]):
                    cost[start][to], word[start][to] = found
    return cost, word


STEPS = {code: step_matrix(code) for code in "suaoSUAOx$"}


def forward(items: list, lo: int, hi: int, start: int) -> tuple[list[int], list[int]]:
    """Least costs from ``start`` over items [lo, hi) to each state, and the rank of each state's least audit."""
    costs, ranks = [NEVER] * 4, [0] * 4
    costs[start] = 0
    for i in range(lo, hi):
        cost, word = items[i]
        best = []
        for to in STATES:
            best.append(min((costs[s] + cost[s][to], ranks[s], word[s][to]) for s in STATES))
        costs = [min(b[0], NEVER) for b in best]
        places = sorted(STATES, key=lambda to: (costs[to] >= NEVER, best[to][1], best[to][2]))
        for place, to in enumerate(places):
            ranks[to] = place
    return costs, ranks


def backward(items: list, lo: int, hi: int, end: int) -> list[int]:
    """Least costs from each state over items [lo, hi) to ``end``."""
    costs = [NEVER] * 4
    costs[end] = 0
    for i in range(hi - 1, lo - 1, -1):
        cost = items[i][0]
        costs = [min(NEVER, min(cost[s][to] + costs[to] for to in STATES)) for s in STATES]
    return costs


def crossings(items: list, start: int, end: int) -> list[int]:
    """The state before each item, and after the last, on the audit-least of the cheapest ways from ``start`` to ``end``."""
    states = [start] + [end] * len(items)
    halves = [(0, len(items))]
    while halves:
        lo, hi = halves.pop()
        if hi - lo < 2:
            continue
        middle = (lo + hi) // 2
        costs, ranks = forward(items, lo, middle, states[lo])
        rest = backward(items, middle, hi, states[hi])
        states[middle] = min(STATES, key=lambda s: (costs[s] + rest[s], ranks[s]))
        halves += [(lo, middle), (middle, hi)]
    return states


def matrix_of(items: list) -> tuple[list[list[int]], list[list[int]]]:
    """All items as one: costs, and ranks of the least audits that begin in one state."""
    both = [forward(items, 0, len(items), s) for s in STATES]
    return [b[0] for b in both], [b[1] for b in both]


def best_end(matrix: tuple) -> tuple[int, int, int]:
    """(cost, state, inserts behind it) of the best way from the first state, given the matrix of all rows."""
    (costs, ranks), (tail, words) = matrix, STEPS["$"]
    ways = [(costs[0][s] + tail[s][e], ranks[0][s], words[s][e], s) for s in STATES for e in ENDS]
    cost, _, word, state = min(ways)
    return cost, state, len(word)


def audit_of(items: list, start: int, end: int, weights: list[int] | None = None) -> str:
    states = crossings(items, start, end)
    letters = [items[i][1][states[i]][states[i + 1]] for i in range(len(items))]
    if weights:
        letters = [w[:-1] + w[-1] * n for w, n in zip(letters, weights)]
    return "".join(letters)


def _repair(codes: str) -> tuple[int, str]:
    items = [STEPS[c] for c in codes]
    cost, end, inserts = best_end(matrix_of(items)) if items else (0, 0, 0)
    return cost, audit_of(items, 0, end) + "I" * inserts


_known = lru_cache(maxsize=100_000)(_repair)


def repair(codes: str) -> tuple[int, str]:
    """(cost, audit) of a conversation, given one code per row. Short ones are often alike, so they are remembered."""
    return _known(codes) if len(codes) <= 24 else _repair(codes)


def repaired_lines(rows: list[tuple[str, str]], audit: str, state: int = 0) -> Iterator[str]:
    """``role:text`` of the rows that an audit leaves; ``rows`` are (role, text)."""
    at = 0
    for letter in audit:
        if letter == "I":
            state, role = NEXT[state]
            yield f"{role}:"
            continue
        role, text = rows[at]
        at += 1
        if letter == "R":
            state, role = NEXT[state]
        elif letter == "K":
            state = READ[role[0]][state]
        if letter != "D":
            yield f"{role}:{text}"


# --- rows


def fault_code(role: str, text: str, again: bool) -> tuple[str, str]:
    """(fault, code) of a row; the first fault counts."""
    if not _SOLID.search(text):
        return "blank", "x"
    if again:
        return "duplicate", "x"
    kind = role[:1] if role[:1] in READ else "o"
    if text.rstrip(_BLANKS)[-1] not in ".!?":
        return "truncated", kind.upper()
    return "", kind


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows as the contract damages them. Dropped rows have no copies."""
    named = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    rows = conversations.select(
        "conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(named.cast("binary")) % 20).alias("harm")
    )
    text = F.when(F.col("harm").isin(0, 1), "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("harm") == 0, 0).when(F.col("harm") == 3, 2).otherwise(1).cast("bigint")
    return rows.select(
        "conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copies")
    )


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of each key, in the order they come; keys are the first columns."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns]):
            if row[:n_keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:n_keys], []
            rows.append(row[n_keys:])
    if rows:
        yield key, rows


class Seen:
    """Counts over rows in order; two of them join into one for the rows of both."""

    FIELDS = "blank duplicate truncated illegal turns least most first_turn last_turn first_role last_role".split()
    TYPES = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, least {t}, most {t}, first_turn {t}, last_turn {t}, first_role string, last_role string"

    def __init__(self, values: tuple = (0, 0, 0, 0, 0, None, None, None, None, None, None)):
        for name, value in zip(self.FIELDS, values):
            setattr(self, name, value)

    def values(self) -> tuple:
        return tuple(getattr(self, name) for name in self.FIELDS)

    def row(self, turn, role: str, fault: str, copies: int = 1, more: str = "") -> None:
        """A row and its further copies, all of which have the fault ``more``."""
        initial = role[:1]
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if copies > 1:
            setattr(self, more, getattr(self, more) + copies - 1)
        apart = Seen((0, 0, 0, (initial + initial not in LEGAL) * (copies - 1), int(turn is not None), turn, turn, turn, turn, initial, initial))
        self.join(apart)

    def join(self, later: Seen) -> None:
        """``later`` holds the rows behind these."""
        if later.first_role is None:
            return
        if self.first_role is None:
            for name in self.FIELDS[4:]:
                setattr(self, name, getattr(later, name))
            self.first_role = later.first_role
        else:
            self.illegal += self.last_role + later.first_role not in LEGAL
            self.turns += later.turns - (later.first_turn is not None and later.first_turn == self.last_turn)
            if later.least is not None:
                self.least = later.least if self.least is None else min(self.least, later.least)
                self.most = later.most if self.most is None else max(self.most, later.most)
            self.last_turn, self.last_role = later.last_turn, later.last_role
        for name in self.FIELDS[:4]:
            setattr(self, name, getattr(self, name) + getattr(later, name))

    def gaps(self) -> int:
        return 0 if self.least is None else int(self.most - self.least + 1 - self.turns)


def _whole(rows: list[tuple]) -> tuple:
    """The result of a conversation whose rows are all here: (turn, role, text, copies) in order."""
    seen, known, kept, codes = Seen(), set(), [], []
    for turn, role, text, copies in rows:
        for _ in range(copies):
            fault, code = fault_code(role, text, (role, text) in known)
            known.add((role, text))
            seen.row(turn, role, fault)
            kept.append((role, text))
            codes.append(code)
    cost, audit = repair("".join(codes))
    text = "\n".join(repaired_lines(kept, audit))
    digest = sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
    return seen.gaps(), seen.blank, seen.duplicate, seen.truncated, seen.illegal, cost, audit, digest


def _in_order(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys, F.col("turn").asc_nulls_first(), "role", "text")


def _flushed(rows: Iterator[tuple], names: list[str], schema: pa.Schema | None = None, size: int = 2000) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out))
        arrays = [pa.array(c, schema.field(i).type if schema else None) for i, c in enumerate(columns)]
        return pa.RecordBatch.from_arrays(arrays, names)

    for row in rows:
        out.append(row)
        if len(out) >= size:
            yield batch()
            out = []
    if out:
        yield batch()


def _map_groups(rows: DataFrame, keys: str, per_group, fields: str) -> DataFrame:
    """``per_group(key, rows)`` gives rows behind the key columns, for rows that are in order by these keys."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    names = keys.split()
    schema = StructType([*rows.select(*names).schema, *StructType.fromDDL(fields)])
    arrow, n = to_arrow_schema(schema), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = (key + tuple(row) for key, group in _groups(batches, n) for row in per_group(key, group))
        return _flushed(out, arrow.names, arrow)

    return rows.mapInArrow(run, schema)


# --- long conversations


def _cost_columns(matrix: tuple) -> tuple[list[int], list[int]]:
    return [c for row in matrix[0] for c in row], [r for row in matrix[1] for r in row]


def _from_columns(costs: list[int], ranks: list[int]) -> tuple:
    return [costs[4 * s : 4 * s + 4] for s in STATES], [ranks[4 * s : 4 * s + 4] for s in STATES]


def _block_items(rows: list[tuple]) -> tuple[list, list[int], list[tuple[str, str]], Seen]:
    """Items, their weights, one (role, text) per row and the counts of a block: (turn, role, text, copies, again)."""
    items, weights, kept, seen = [], [], [], Seen()
    for turn, role, text, copies, again in rows:
        fault, code = fault_code(role, text, again)
        seen.row(turn, role, fault, copies, "blank" if fault == "blank" else "duplicate")
        items.append(STEPS[code])
        weights.append(1)
        kept.append((role, text))
        if copies > 1:
            items.append(step_matrix("x", copies - 1))
            weights.append(copies - 1)
    return items, weights, kept, seen


def _summary(_, rows: list[tuple]) -> Iterator[tuple]:
    items, _, _, seen = _block_items(rows)
    yield (*seen.values(), *_cost_columns(matrix_of(items)))


def _joined(_, rows: list[tuple]) -> Iterator[tuple]:
    """Blocks in order as one block: (block, counts, costs, ranks)."""
    seen = Seen()
    for row in rows:
        seen.join(Seen(row[1:-2]))
    yield (*seen.values(), *_cost_columns(matrix_of([_from_columns(*row[-2:]) for row in rows])))


def _dealt(_, rows: list[tuple]) -> Iterator[tuple]:
    """The crossings of blocks in order, given those of all of them: (block, costs, ranks, start, end)."""
    states = crossings([_from_columns(row[1], row[2]) for row in rows], rows[0][3], rows[0][4])
    for row, start, end in zip(rows, states, states[1:]):
        yield row[0], start, end


def _repaired_block(key: tuple, rows: list[tuple]) -> Iterator[tuple]:
    """Pieces of audit and repaired text: (turn, role, text, copies, again, start, end)."""
    items, weights, kept, _ = _block_items([row[:5] for row in rows])
    start, end = rows[0][5:]
    short = audit_of(items, start, end)
    lines = repaired_lines([r for r, row in zip(kept, rows) for _ in range(1 + (row[3] > 1))], short, start)
    whole = audit_of(items, start, end, weights) if max(weights) > 1 else short
    piece, size, number = [], 0, 0
    for line in lines:
        piece.append(line)
        size += len(line)
        if size >= PIECE_BYTES:
            yield number, "", "\n".join(piece).encode("utf-8", "surrogatepass")
            piece, size, number = [], 0, number + 1
    yield number, whole, "\n".join(piece).encode("utf-8", "surrogatepass") if piece else None


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hot, audit, repaired_sha256) from the pieces of each conversation in order; one piece is held at a time."""

    def rows() -> Iterator[tuple]:
        key, audits, digest, begun = None, [], sha256(), False
        for batch in batches:
            for hot, audit, piece in zip(*[batch.column(i).to_pylist() for i in (0, 3, 4)]):
                if hot != key:
                    if key is not None:
                        yield key, "".join(audits), digest.hexdigest()
                    key, audits, digest, begun = hot, [], sha256(), False
                audits.append(audit)
                if piece is not None:
                    if begun:
                        digest.update(b"\n")
                    digest.update(piece)
                    begun = True
        if key is not None:
            yield key, "".join(audits), digest.hexdigest()

    return _flushed(rows(), ["hot", "audit", "repaired_sha256"], size=1)


def _long_conversations(rows: DataFrame, hot: DataFrame, n_blocks: int, fan: int) -> DataFrame:
    """Results of the conversations in ``hot`` (conv_id, hot); ``rows`` are theirs, with the number ``hot``."""
    turn = rows.schema["turn"].dataType.simpleString()
    counts, matrix = Seen.TYPES.format(t=turn), "costs array<bigint>, ranks array<bigint>"
    counted = rows.where("copies > 0").groupBy("hot", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    counted = counted.withColumn("digest", F.md5("text"))
    place = F.struct(F.col("turn").isNotNull().alias("dated"), "turn")
    ends = counted.groupBy("hot", "role", "digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    twice = store(ends.where("first <> last").drop("last"), "repeated-turns")
    again = F.coalesce(place != F.col("first"), F.lit(False))
    told = counted.join(twice, ["hot", "role", "digest"], "left").select("hot", "turn", "role", "text", "copies", again.alias("again"))
    ranges = told.repartitionByRange(n_blocks, "hot", F.col("turn").asc_nulls_first(), "role", "text")
    blocks = store(ranges.withColumn("block", F.spark_partition_id().cast("bigint")), "blocks")
    content = ["hot", "block", "turn", "role", "text", "copies", "again"]

    levels = [store(_map_groups(_in_order(blocks.select(content), "hot", "block"), "hot block", _summary, f"{counts}, {matrix}"), "level")]
    width = n_blocks
    while True:  # ends with one row per conversation
        below = levels[-1].select(F.floor(F.col("block") / fan).alias("up"), "*").select("hot", "up", "block", *Seen.FIELDS, "costs", "ranks")
        joined = _map_groups(below.repartition("hot", "up").sortWithinPartitions("hot", "up", "block"), "hot up", _joined, f"{counts}, {matrix}")
        levels.append(store(joined.withColumnRenamed("up", "block"), "level"))
        width = -(-width // fan)
        if width <= 1:
            break

    def root(_, group: list[tuple]) -> Iterator[tuple]:
        values = group[0]
        cost, end, inserts = best_end(_from_columns(*values[-2:]))
        seen = Seen(values[1:-2])
        yield values[0], seen.gaps(), *seen.values()[:4], cost, 0, end, inserts

    fields = "block bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, start int, end int, inserts int"
    ordered = levels[-1].repartition("hot").sortWithinPartitions("hot")
    tops = store(_map_groups(ordered, "hot", root, fields), "tops")
    states = tops.select("hot", "block", "start", "end")
    for level in reversed(levels[:-1]):
        above = states.withColumnRenamed("block", "up")
        below = level.select("hot", F.floor(F.col("block") / fan).alias("up"), "block", "costs", "ranks").join(above, ["hot", "up"])
        below = below.select("hot", "up", "block", "costs", "ranks", "start", "end")
        dealt = _map_groups(below.repartition("hot", "up").sortWithinPartitions("hot", "up", "block"), "hot up", _dealt, "block bigint, start int, end int")
        states = store(dealt.drop("up"), "crossings")
    final = blocks.join(states, ["hot", "block"]).select(*content, "start", "end")
    pieces = _map_groups(_in_order(final, "hot", "block"), "hot block", _repaired_block, "number int, audit string, piece binary")
    # inserts behind the last row: from the state after a user row one, after a system row two
    tail = F.when(F.col("inserts") == 1, "assistant:").otherwise("user:\nassistant:").cast("binary").alias("piece")
    last = F.lit(n_blocks).cast("bigint").alias("block")
    tails = tops.where("inserts > 0").select("hot", last, F.lit(0).alias("number"), F.repeat(F.lit("I"), F.col("inserts")).alias("audit"), tail)
    pieces = pieces.unionByName(tails).repartition("hot").sortWithinPartitions("hot", "block", "number")
    texts = pieces.mapInArrow(_streamed, "hot bigint, audit string, repaired_sha256 string")
    return hot.join(tops, "hot").join(texts, "hot").select("conv_id", *RESULT_NAMES)


def query(conversations: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """One row per conversation: its counts of faults, the cost and letters of its cheapest edits, the repaired text's hash."""
    rows = damaged(conversations)
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("n"), F.sum(F.col("copies") * F.octet_length("text")).alias("size"))
    hot = sizes.where((F.col("n") > block_rows) | (F.col("size") > block_bytes))
    hot = store(hot.select(F.monotonically_increasing_id().alias("hot"), "conv_id", "n", "size"), "long")
    total = hot.agg(F.sum("n").alias("n"), F.sum("size").alias("size")).first()
    if total["n"] is not None:
        keys = hot.select("hot", F.col("conv_id").alias("long_id"))
        same = rows["conv_id"].eqNullSafe(keys["long_id"])
        longs = rows.join(keys, same).drop("conv_id", "long_id")
        rows = rows.join(keys, same, "left_anti")
    whole = _map_groups(_in_order(rows, "conv_id"), "conv_id", lambda _, group: [_whole(group)], RESULT)
    if total["n"] is None:
        return whole
    n_blocks = 1 + max(total["n"] // block_rows, total["size"] // block_bytes)
    return whole.unionByName(_long_conversations(longs, hot.drop("n", "size"), n_blocks, fan))
