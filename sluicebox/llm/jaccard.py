"""N-gram Jaccard join by parity sketches.

A text's distinct five-word shingles are hashed into the parts of a sketch; each part is the XOR of its shingles, so it
depends on which of them occur an odd number of times between two texts: the parts (and the parity bits) in which two
sketches differ are at most as many as the shingles in which the sets differ. Sets with Jaccard similarity of 3/4 or
more differ in at most a seventh of their joint size, so among enough non-empty parts one is equal (pigeonhole). The
number of parts follows the size band of the set; a set near the upper border also takes part in the next band.

1. Every non-empty part is exchanged once, packed by bucket of its hash. Parts that no other set has are only counted.
2. A set keeps as many of its rarest parts as can differ, plus one. Two linked sets keep a common one. Sets with too many
   parts of their own can have no partner and are gone.
3. Sets that keep a part are held against the smallest of them, by parity bits and then exactly: first one pair for each set, then
   the pairs whose components are still apart. Where a part's sets are in different components after that, they meet in
   cells of a bounded number of sets. Parts of its own always differ, which rules most pairs of a hot passage out before
   they are made; the rest are held against each other as bit matrices. A cell gives a forest of what is close, not its pairs.
4. Sets that such forests connect meet once more, with their shingles, in smaller cells. There close pairs are compared exactly
   unless earlier links of the cell connect them, so no step makes more rows than its cells have sets.

So all links matter to the components, while copies are never expanded into pairs. Sets are named by 63-bit hashes of their
shingles; inside a pair, shingles are compared by 40 bits. The chance that hashes mistake one for another is below one in
a million for each pair, and wrong equality can only add a link at the very border.

Defined results: null and wordless texts have no shingles and are their own component; up to four words are one shingle;
equal texts share a component; a component of null ids only has the id null; repeated rows give repeated results; an empty
table gives no rows. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluicebox.llm.common import doc_slices, map_texts, store
from sluicebox.llm.graph import components

SHINGLE = 5
SMALL = 256  # smaller sets have a part for each shingle
BUCKET_PARTS = 2_500_000
SORT_PARTS = 600_000
FLUSH_PARTS = 600_000
SLICE_BUCKETS = 3
BLOCK_SETS = 200
CELL_SETS = 2_000
EXACT_SETS = 500
EXACT_SHINGLES = 1_000_000
CELL_ROWS = 128
CELL_PAIRS = 16_384
MAX_BITS = 8192
SIFT_BITS = 1 << 24  # broadcast as at most 262,144 rows of 64 bits
CACHE_WORDS = 300_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)
UNIT = "a bigint, b bigint"


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of the shingles of texts."""

    def __init__(self):
        self.words: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else []
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(words) < SHINGLE:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], dtype=np.uint64)
        known = self.words
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        if len(known) > CACHE_WORDS:
            known.clear()
        n = len(words) - SHINGLE + 1
        total = hashes[:n].copy()
        for k in range(1, SHINGLE):
            total = mixed(total * FACTOR + hashes[k : k + n])
        return np.unique(total)


def set_name(shingles: np.ndarray) -> int:
    """An even 63-bit number; the odd one next to it names the set where it takes part in the next band."""
    return (xxhash.xxh3_64_intdigest(shingles.tobytes()) & ~1) - (1 << 63)


def band_of(n: int) -> int:
    return (n.bit_length() - 1) // 2


def bands(n: int) -> list[int]:
    """Where a set of n shingles takes part: in its band, and in the next if a partner can be there."""
    band = band_of(n)
    return [band, band + 1] if 4 * n >= 3 * 4 ** (band + 1) else [band]


def parts(shingles: np.ndarray, band: int) -> np.ndarray:
    """Hashes of the non-empty parts of a sketch: (band, part, XOR of its shingles)."""
    if 4 ** (band + 1) <= SMALL:
        return mixed(shingles + np.uint64(band))
    count = np.uint64(4 ** (band + 1) // 2)
    part = (shingles >> np.uint64(32)) * count >> np.uint64(32)  # ascending, as the shingles are
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    return mixed(np.bitwise_xor.reduceat(mixed(shingles), first) + mixed(part[first] + (np.uint64(band) << np.uint64(40))))


def count_parts(shingles: np.ndarray, band: int) -> int:
    """How many ``parts`` there are, without their hashes."""
    if 4 ** (band + 1) <= SMALL:
        return len(shingles)
    part = (shingles >> np.uint64(32)) * np.uint64(4 ** (band + 1) // 2) >> np.uint64(32)
    return 1 + int(np.count_nonzero(part[1:] != part[:-1]))


def parity_bits(shingles: np.ndarray) -> bytes:
    """A parity sketch with a bit count that follows the size band; folding halves gives the sketch of fewer bits."""
    size = max(64, min(MAX_BITS, 4 ** (band_of(len(shingles)) + 1)))
    bits = np.bincount((mixed(shingles) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two parity sketches, at the width of the narrower."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) > len(y):
        x, y = y, x
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def differs_at_most(n: int, m: int) -> int:
    """The largest symmetric difference of two linked sets of n and m elements."""
    return (n + m) // 7


def may_differ(n: int) -> int:
    """How many parts of a set of n shingles can differ from those of a linked set."""
    return n // 3


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= 75 * (len(a) + len(b) - common)


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n, name, e0, e1, bits): set size and name, non-empty parts by band, parity bits."""

    def start():
        shingler = Shingler()

        def run(texts):
            sizes, names, first, second, bits = [], [], [], [], []
            for text in texts:
                shingles = shingler(text)
                n = len(shingles)
                counts = [count_parts(shingles, band) for band in bands(n)] if n else [0]
                sizes.append(n)
                names.append(set_name(shingles) if n else None)
                first.append(counts[0])
                second.append(counts[1] if len(counts) > 1 else 0)
                bits.append(parity_bits(shingles) if n else None)
            return [sizes, names, first, second, bits]

        return run

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return map_texts(rows, start, "n bigint, name bigint, e0 int, e1 int, bits binary", keep="doc_id text_hash")


def _packed_parts(docs: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, names, counts, parts): per task and bucket the parts of many sets, packed; equal sets of a task once."""

    def run(batches):
        shingler, seen = Shingler(), set()
        names, keys, sizes, held = [], [], [], 0

        def flush():
            if not keys:
                return
            every = np.concatenate(keys)
            keys.clear()
            owner = np.repeat(np.arange(len(names)), sizes)
            bucket = ((every >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")
            every, owner, bucket = every[order].astype(np.uint32), owner[order], bucket[order]
            borders = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            of = np.array(names, dtype=np.int64)
            rows = []
            for a, b in zip(borders[:-1], borders[1:]):
                who, count = np.unique(owner[a:b], return_counts=True)
                rows.append((int(bucket[a]), of[who].tobytes(), count.astype(np.uint16).tobytes(), every[a:b].tobytes()))
            names.clear(), keys.clear(), sizes.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3))],
                ["bucket", "names", "counts", "parts"],
            )

        for _, texts in doc_slices(batches):
            for text in texts:
                shingles = shingler(text)
                name = set_name(shingles) if len(shingles) else None
                if name is None or name in seen:
                    continue
                seen.add(name)
                for k, band in enumerate(bands(len(shingles))):
                    own = parts(shingles, band)
                    for at in range(0, len(own), 60_000):  # counts are 16-bit numbers
                        names.append(name + k)
                        keys.append(own[at : at + 60_000])
                        sizes.append(len(keys[-1]))
                    held += len(own)
            if held > FLUSH_PARTS:
                yield from flush()
                held = 0
        yield from flush()

    return docs.select("text").mapInArrow(run, "bucket int, names binary, counts binary, parts binary")


def _shared_parts(packed: DataFrame, n_buckets: int) -> DataFrame:
    """(name, n_shared, key, many): for each set the parts that other sets have too, and in how many sets.

    Buckets of parts come first; what they find is packed by slices of sets, and put together there.
    """
    n_slices = 1 + n_buckets // SLICE_BUCKETS

    def shared(names, counts, low):
        """(low, name, sets) of the parts that several sets have, from a share of the bucket at a time."""
        n_shares = 1 + len(low) // SORT_PARTS
        share = (low.astype(np.uint64) * np.uint64(n_shares) >> np.uint64(32)).astype(np.uint32)
        owner = np.repeat(np.arange(len(names), dtype=np.uint32), counts)
        for k in range(n_shares):
            here = share == k
            part, of = low[here], names[owner[here]]
            order = np.lexsort((of, part))
            part, of = part[order], of[order]
            fresh = np.concatenate([[True], (part[1:] != part[:-1]) | (of[1:] != of[:-1])])[: len(part)]
            part, of = part[fresh], of[fresh]
            starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.zeros(1, np.int64)
            sets = np.repeat(np.diff(starts), np.diff(starts))
            yield part[sets > 1], of[sets > 1], sets[sets > 1].astype(np.uint32)

    def by_bucket(batches):
        for bucket, rows in _gathered(batches):
            columns = [np.concatenate([np.frombuffer(r[k], kind) for r in rows]) for k, kind in enumerate((np.int64, np.uint16, np.uint32))]
            rows.clear()
            low, names, sets = (np.concatenate(c) for c in zip(*shared(*columns)))
            columns.clear()
            piece = mixed(names.view(np.uint64)) % np.uint64(n_slices)
            order = np.lexsort((names, piece))
            low, names, sets, piece = low[order], names[order], sets[order], piece[order]
            borders = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1], [True]])) if len(names) else []
            out = []
            for a, b in zip(borders[:-1], borders[1:]):
                who, count = np.unique(names[a:b], return_counts=True)
                out.append((int(piece[a]), bucket, who.tobytes(), count.astype(np.uint32).tobytes(), low[a:b].tobytes(), sets[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([r[k] for r in out], pa.int32()) for k in (0, 1)), *(pa.array([r[k] for r in out], pa.binary()) for k in (2, 3, 4, 5))],
                ["slice", "bucket", "names", "counts", "parts", "sets"],
            )

    def by_slice(batches):
        for _, rows in _gathered(batches):
            names, counts, low, sets = (
                np.concatenate([np.frombuffer(r[k], kind) for r in rows]) for k, kind in enumerate((np.int64, np.uint32, np.uint32, np.uint32), start=1)
            )
            buckets = np.repeat(np.array([r[0] for r in rows], dtype=np.uint64), [len(r[3]) // 4 for r in rows])
            rows.clear()
            key = (buckets << np.uint64(32)) | low.astype(np.uint64)
            names = np.repeat(names, counts)
            order = np.lexsort((key, sets, names))  # of a set, the rarest come first
            names, key, sets = names[order], key[order], sets[order]
            borders = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1], [True]]))
            for at in range(0, len(borders) - 1, 2048):
                some = borders[at : at + 2049]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[some[:-1]]),
                        pa.array(np.diff(some).astype(np.int32)),
                        pa.array([key[a:b].tobytes() for a, b in zip(some[:-1], some[1:])], pa.binary()),
                    ],
                    ["name", "n_shared", "keys"],
                )

    found = packed.repartitionById(n_buckets, "bucket").mapInArrow(
        by_bucket, "slice int, bucket int, names binary, counts binary, parts binary, sets binary"
    )
    return found.repartitionById(n_slices, "slice").mapInArrow(by_slice, "name bigint, n_shared int, keys binary")


def _gathered(batches):
    """(number, rows without it) for each number in the first column of a partition."""
    groups: dict[int, list[tuple]] = {}
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            groups.setdefault(row[0], []).append(row[1:])
    while groups:
        yield groups.popitem()


def _rarest(units: DataFrame) -> DataFrame:
    """(key, name, n, own): of each set, its rarest shared parts, up to the count that can differ, plus one.

    ``own`` counts the parts that no other set of the band has.
    """

    def run(batches):
        for batch in batches:
            out_key, out_name, out_n, out_own = [], [], [], []
            for name, n, own, keys in zip(*(column.to_pylist() for column in batch.columns)):
                kept = np.frombuffer(keys, np.uint64)[: may_differ(n) + 1 - own]
                out_key.append(kept.astype(np.int64))
                out_name.append(np.full(len(kept), name & ~1, dtype=np.int64))
                out_n.append(np.full(len(kept), n, dtype=np.int64))
                # under two bits of a sketch may lie one shingle of each set, under a part per shingle only one set's
                out_own.append(np.full(len(kept), own if _part_per_shingle(n, name & 1) else -own, dtype=np.int64))
            if out_key:
                columns = [pa.array(np.concatenate(c)) for c in (out_key, out_name, out_n, out_own)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "name", "n", "own"])

    return units.select("name", "n", "own", "keys").mapInArrow(run, "key bigint, name bigint, n bigint, own bigint")


def _part_per_shingle(n: int, next_band: int) -> bool:
    return 4 ** (band_of(n) + next_band + 1) <= SMALL


def may_link(n: np.ndarray, own: np.ndarray, m: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether sets that keep one part may be linked, by their sizes and their own parts (negative: parts of XOR sums).

    Own parts of both sets add up where each is one shingle; own sums of both may lie on one place, so the larger count holds.
    """
    apart = np.where(own >= 0, own + other, np.maximum(-own, -other))
    return (4 * n >= 3 * m) & (4 * m >= 3 * n) & (apart <= (n + m) // 7)


def _folded(bits: list[bytes], width: int) -> np.ndarray:
    """Parity sketches as rows of a matrix, folded to ``width`` bytes."""
    out = np.zeros((len(bits), width), dtype=np.uint8)
    for at, one in enumerate(bits):
        out[at] = np.bitwise_xor.reduce(np.frombuffer(one, np.uint8).reshape(-1, width), axis=0)
    return out


def close_in_cell(names: np.ndarray, n: np.ndarray, own: np.ndarray, component: np.ndarray, side: np.ndarray, bits: list[bytes]):
    """Index pairs of sets of different components and, in a cell of two sides, of different sides, that sizes, own parts and bits allow."""
    order = np.argsort(n, kind="stable")
    names, n, own, component, side = names[order], n[order], own[order], component[order], side[order]
    bits = [bits[k] for k in order]
    widths = np.array([len(b) for b in bits])
    matrices: dict[int, np.ndarray] = {}
    two = side.min() != side.max()
    for start in range(0, len(names), CELL_ROWS):
        a = np.arange(start, min(start + CELL_ROWS, len(names)))
        end = int(np.searchsorted(n, 4 * n[a[-1]] // 3, side="right"))  # partners of at least the same place in the order of sizes
        b = np.arange(start, end)
        good = may_link(n[a, None], own[a, None], n[None, b], own[None, b]) & (component[a, None] != component[None, b]) & (a[:, None] < b[None, :])
        if two:
            good &= side[a, None] != side[None, b]
        i, j = np.nonzero(good)
        i, j = a[i], b[j]
        narrow = np.minimum(widths[i], widths[j])
        for width in np.unique(narrow):
            if width not in matrices:
                fits = np.flatnonzero(widths >= width)
                matrices[width] = (np.searchsorted(fits, np.arange(len(bits))), _folded([bits[k] for k in fits], int(width)))
            place, matrix = matrices[width]
            some = np.flatnonzero(narrow == width)
            for at in range(0, len(some), CELL_PAIRS):
                x, y = i[some[at : at + CELL_PAIRS]], j[some[at : at + CELL_PAIRS]]
                near = np.bitwise_count(matrix[place[x]] ^ matrix[place[y]]).sum(axis=1, dtype=np.int64) <= (n[x] + n[y]) // 7
                for left, right in zip(names[x[near]].tolist(), names[y[near]].tolist()):
                    yield min(left, right), max(left, right)


class Forest:
    """Trees of nodes; ``join`` says whether two nodes were apart, and puts their trees together."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, node: int) -> int:
        while (above := self.up.get(node, node)) != node:
            self.up[node] = node = self.up.get(above, above)
        return node

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _in_cells(rows: DataFrame, group: str, blocks) -> DataFrame:
    """The rows with ``low``, ``high`` and ``side``, once for each cell of their group: its blocks by hash of ``name``, in pairs."""
    block = F.pmod(F.xxhash64("name"), blocks)
    cells = F.transform(
        F.sequence(F.lit(0).cast("bigint"), blocks - 1),
        lambda other: F.struct(F.least("block", other).alias("low"), F.greatest("block", other).alias("high")),
    )
    rows = rows.withColumn("block", block).withColumn("cell", F.explode(cells))
    side = (F.col("block") == F.col("cell.low")).cast("bigint").alias("side")
    kept = [name for name in rows.columns if name not in (group, "blocks", "block", "cell")]
    return rows.select(F.col(group).alias("key"), "cell.low", "cell.high", side, *kept).repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")


def _cell_rows(batches, found):
    """``found(rows)`` as (a, b) batches, for the rows of each cell; the first three columns name it."""

    def given(held):
        pairs = found(held)
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

    current, held = None, []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if row[:3] != current:
                if held:
                    yield given(held)
                current, held = row[:3], []
            held.append(row[3:])
    if held:
        yield given(held)


def _close_forest(kept: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect all close sets of different components that keep one part; ``kept`` has (key, name, n, own, component).

    Of a part's sets, those stay that some other may be linked with by the counts of own parts. They are dealt into blocks by hash;
    each pair of blocks is a cell, so a task holds two blocks at a time, and gives a forest of the close pairs in it.
    """
    spare = F.when(F.col("own") >= 0, 7 * F.col("own") - F.col("n")).otherwise(F.lit(0))
    rows = kept.withColumn("spare", spare)
    best = rows.groupBy("key").agg(F.min("spare").alias("best"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    rows = rows.join(best.select("key", "best"), "key").where("spare + best <= 0").select("key", "name", "n", "own", "component")
    rows = store(rows, "jaccard-mixed")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("many"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    blocks = sizes.select("key", (1 + F.expr(f"(many - 1) div {CELL_SETS}")).alias("blocks"))
    rows = rows.join(blocks, "key").join(sets.select("name", "bits"), "name").select("key", "blocks", "name", "n", "own", "component", "bits")

    def forest(rows):
        side, names, n, own, component, bits = zip(*rows)
        numbers = (np.array(c, dtype=np.int64) for c in (names, n, own, component, side))
        trees = Forest()
        return [pair for pair in close_in_cell(*numbers, list(bits)) if trees.join(*pair)]

    return _in_cells(rows, "key", F.col("blocks")).mapInArrow(lambda batches: _cell_rows(batches, forest), UNIT).distinct()


def _across(docs: DataFrame, kept: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect what is linked among the sets of different components that keep one part.

    Linked sets are in one tree of the forests of close sets. The sets of a tree are dealt into blocks, of EXACT_SETS sets and
    EXACT_SHINGLES shingles on average; in each pair of blocks, close pairs are compared exactly unless links already connect them.
    """
    trees = components(store(_close_forest(kept, sets), "jaccard-close")).select(F.col("node").alias("name"), F.col("component").alias("tree"))
    own = kept.groupBy("name").agg(F.min("component").alias("component"))
    known = sets.select("name", "n", "bits", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash"))
    rows = store(trees.join(own, "name").join(known, "name"), "jaccard-trees")
    texts = _sifted(docs, rows)
    most = F.greatest(F.expr(f"(count(1) - 1) div {EXACT_SETS}"), F.expr(f"sum(n) div {EXACT_SHINGLES}"))
    rows = rows.join(rows.groupBy("tree").agg((1 + most).alias("blocks")), "tree")
    same = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_hash") == F.col("rep_hash"))
    columns = ["tree", "blocks", "name", "n", "component", "bits"]

    def start():
        shingler = Shingler()
        return lambda column: [[shingler(text).view(np.uint8).reshape(-1, 8)[:, :5].tobytes() for text in column]]

    packed = map_texts(texts.join(rows, same), start, "packed binary", keep=" ".join(columns))

    def links(rows):
        side, names, n, component, bits, packed = zip(*rows)
        numbers = (np.array(c, dtype=np.int64) for c in (names, n, [0] * len(n), component, side))
        of, sets_of, trees = dict(zip(names, packed)), dict(zip(names, component)), Forest()
        found = []
        for a, b in close_in_cell(*numbers, list(bits)):
            x, y = sets_of[a], sets_of[b]
            if trees.root(x) != trees.root(y) and linked(_unpacked(of[a]), _unpacked(of[b])):
                trees.join(x, y)
                found.append((a, b))
        return found

    return _in_cells(packed, "tree", F.col("blocks")).mapInArrow(lambda batches: _cell_rows(batches, links), UNIT).distinct()


def _unpacked(packed: bytes) -> np.ndarray:
    """Shingles of 40 bits as numbers."""
    out = np.zeros((len(packed) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    return out.view(np.uint64).ravel()


def _close(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sizes and parity bits allow a link."""
    a = sets.select(F.col("name").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    b = sets.select(F.col("name").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))

    def run(batches):
        for batch in batches:
            rows = [c.to_pylist() for c in batch.columns]
            keep = [distance(x, y) <= differs_at_most(n, m) for n, m, x, y in zip(*rows[2:])]
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    near = pairs.join(a, "a").join(b, "b").where("4 * n_a >= 3 * n_b and 4 * n_b >= 3 * n_a")
    return near.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, UNIT)


def _sifted(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, text, text_hash) of the documents that may be among the stored (rep_id, rep_hash), and of few others.

    A bitmap of bounded size is broadcast and tells them apart before the join that follows, so texts nobody asks for are not shuffled.
    """
    size = min(SIFT_BITS, max(64, 1 << (16 * wanted.count()).bit_length()))
    mark = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    bits = wanted.select(F.pmod(F.xxhash64("rep_id", "rep_hash"), F.lit(size)).alias("bit"))
    marks = bits.groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(mark).alias("marks"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    texts = texts.withColumn("bit", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(size)))
    return texts.join(F.broadcast(marks), F.expr("bit div 64 = word")).where(F.col("marks").bitwiseAND(mark) != 0).select("doc_id", "text", "text_hash")


def _verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The linked pairs. A set and at most some BLOCK_SETS partners make a block; a set of more partners has more blocks."""
    blocks = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("partners")).select("a", (1 + F.expr(f"partners div {BLOCK_SETS}")).alias("blocks"))
    members = pairs.join(blocks, "a").select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block"), F.lit(1).alias("rank"), F.col("b").alias("name"))
    owners = blocks.select("a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("rank"), F.col("a").alias("name"))
    wanted = members.unionByName(owners).join(sets.select("name", "rep"), "name")
    wanted = store(wanted.select("a", "block", "rank", "name", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash")), "jaccard-wanted")
    same = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_hash") == F.col("rep_hash"))
    rows = _sifted(docs, wanted).join(wanted, same).select("a", "block", "rank", "name", "text")

    def to_sets(batches):
        shingler = Shingler()
        for part, column in doc_slices(batches):
            packed = [shingler(t).view(np.uint8).reshape(-1, 8)[:, :5].tobytes() for t in column]
            yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(packed, pa.binary())], ["a", "block", "rank", "name", "packed"])

    def compare(batches):
        owner, own = None, None
        for batch in batches:
            found = []
            for a, rank, name, packed in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4))):
                shingles = _unpacked(packed)
                if rank == 0:
                    owner, own = a, shingles
                elif owner == a and linked(own, shingles):
                    found.append((a, name))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    packed = rows.mapInArrow(to_sets, "a bigint, block bigint, rank int, name bigint, packed binary")
    return packed.repartition("a", "block").sortWithinPartitions("a", "block", "rank").mapInArrow(compare, UNIT).distinct()


def _candidates(docs: DataFrame, sets: DataFrame, total: int) -> DataFrame:
    """(key, name, n, own): the parts that sets keep, as far as at least two sets do."""
    n_buckets = 1 + total // BUCKET_PARTS
    units = _shared_parts(_packed_parts(docs, n_buckets), n_buckets)
    known = sets.select(F.col("name").alias("base"), "n", "e0", "e1")
    units = units.withColumn("base", F.col("name").bitwiseAND(F.lit(-2)))
    units = units.join(known, "base").withColumn("own", F.when(F.col("name") == F.col("base"), F.col("e0")).otherwise(F.col("e1")) - F.col("n_shared"))
    return _rarest(units.where("own <= n div 3"))


def find_components(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Described documents, (name, component) of the sets that have links, and all sets."""
    docs = docs.select("doc_id", "text")
    described = store(describe(docs), "jaccard-documents")
    sets = store(
        described.where("n > 0").groupBy("name").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.min("doc_id").alias("least_id"),
            *(F.min(c).alias(c) for c in ("n", "e0", "e1")), F.min("bits").alias("bits"),
        ),
        "jaccard-sets",
    )
    total = sets.agg(F.sum(F.col("e0") + F.col("e1")).alias("parts")).first()["parts"] or 0
    kept = store(_candidates(docs, sets, total), "jaccard-parts")
    least = store(kept.groupBy("key").agg(F.min("name").alias("a"), F.max("name").alias("z")).where("a <> z").select("key", "a"), "jaccard-keys")
    stars = kept.join(least, "key").where("name <> a").select("key", "n", "a", F.col("name").alias("b"))
    tried = links = labels = None

    def round_of(near: DataFrame) -> None:
        """Hold close pairs against each other that were not yet; then tell components anew."""
        nonlocal tried, links, labels
        if tried is not None:
            near = near.join(tried, ["a", "b"], "left_anti")
        near = store(near, "jaccard-pairs")
        found = store(_verified(docs, sets, near), "jaccard-links")
        tried = near if tried is None else tried.union(near)
        links = found if links is None else links.union(found)
        labels = store(components(links), "jaccard-components")

    def component_of(rows: DataFrame, name: str, out: str) -> DataFrame:
        own = labels.select(F.col("node").alias(name), F.col("component").alias(out))
        return rows.join(own, name, "left").withColumn(out, F.coalesce(out, name))

    round_of(_close(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), sets))
    apart = component_of(component_of(stars.select("a", "b").distinct(), "a", "x"), "b", "y").where("x <> y")
    round_of(_close(store(apart.select("a", "b"), "jaccard-apart"), sets))
    found = store(_across(docs, component_of(kept, "name", "component"), sets), "jaccard-links")
    labels = store(components(links.union(found)), "jaccard-components")
    return described, labels, sets


def query(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document."""
    described, labels, sets = find_components(docs)
    named = sets.select("name", "least_id").join(labels.withColumnRenamed("node", "name"), "name", "left")
    named = named.withColumn("component", F.coalesce("component", "name"))
    ids = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_set = store(named.join(ids, "component").select("name", "component_id"), "jaccard-ids")
    rows = described.select("doc_id", F.col("n").alias("n_shingles"), "name")
    linked_rows = rows.where("name is not null").join(of_set, "name").select("doc_id", "n_shingles", "component_id")
    return linked_rows.unionByName(rows.where("name is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _verdicts(docs: DataFrame) -> DataFrame:
    """(_id, _hash, _first, _copies): whether rows of this id and text are the first of their component, and how many they are.

    The first of a component has the smallest id, then the smallest text hash; null ids come last. Rows without shingles,
    and single rows that are first, are not in the result.
    """
    described, labels, _ = find_components(docs)
    known = described.where("name is not null")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    named = known.groupBy("name").agg(F.min(place).alias("best")).join(labels.withColumnRenamed("node", "name"), "name", "left")
    named = named.withColumn("component", F.coalesce("component", "name"))
    least = named.groupBy("component").agg(F.min("best").alias("first"))
    of_set = store(named.join(least, "component").select("name", "first"), "jaccard-first")
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    rows = known.join(of_set, "name").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), is_first.alias("_first"))
    judged = rows.groupBy("_id", "_hash").agg(F.min("_first").alias("_first"), F.count(F.lit(1)).alias("_copies"))
    return store(judged.where("not _first or _copies > 1"), "jaccard-verdicts")


def stage(docs: DataFrame) -> DataFrame:
    """All columns of one document per component: the smallest id, then the smallest text hash; null ids come last.

    Of rows repeated with id and text, one stays, chosen by a hash of the other columns. Documents without shingles stay.
    """
    verdicts = _verdicts(docs)
    row = docs.select(F.struct(*(docs[name] for name in docs.columns)).alias("doc"), F.xxhash64("text").alias("hash"))  # columns may have any name
    same = F.col("doc.doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    single = row.join(verdicts, same, "left_anti").select("doc.*")
    again = store(verdicts.where("_first").select("_id", "_hash"), "jaccard-again")
    other = [f.name for f in docs.schema if f.name not in ("doc_id", "text") and "map<" not in f.dataType.simpleString()]
    order = F.xxhash64(*(F.col("doc")[name] for name in other)) if other else F.lit(0)
    each = Window.partitionBy("_id", "_hash").orderBy("order")
    repeated = row.join(again, same).withColumn("order", order).withColumn("nth", F.row_number().over(each)).where("nth = 1")
    return single.unionByName(repeated.select("doc.*"))
