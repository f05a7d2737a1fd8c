"""Suffix-array deduplication: bytes covered by a 400-byte string that starts anywhere else are removed.

Not every suffix has to be sorted. Each window of LENGTH bytes names one place inside itself, its anchor: the first of its GRAM-byte
strings with the least hash. Equal windows have equal anchors, so windows with one anchor are a unit, judged by what
stands around the anchor.

1. Units are counted by content. Windows of a unit that occurs twice are repeated. Units whose anchor string occurs nowhere
   else are unique. What is left, once per content, has its anchor suffix sorted.
2. Tasks sort suffixes into runs and front-code them (length of the common prefix with the one before, and the rest).
   Runs are exchanged by ranges and merged by loser trees that know how long a prefix each run's head shares with the
   last winner, so known prefixes are never compared again; the merge gives the common prefix of neighbours.
3. Neighbours that share the anchor string make a group. Common prefixes tell which windows of a suffix can occur again; these
   are compared by hash inside the group, or, in large groups, by a count over all of Spark.

Contents are told apart by 64-bit hashes (windows by 128), documents by a 64-bit hash of id and text.

Defined results: null and empty texts keep the empty string; texts shorter than LENGTH bytes lose nothing; repeated rows
are separate documents, so each loses what the other has; an empty table gives no rows. Only doc_id and text are read,
so other columns may have any name.
"""

from __future__ import annotations

import gc
import hashlib
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sluicebox.llm.common import discard, doc_slices, store
from sluicebox.llm.jaccard import FACTOR, mixed

LENGTH = 400
GRAM = 64
WINDOWS = LENGTH - GRAM + 1
RUN_BYTES = 48_000_000
RANGE_BYTES = 16_000_000
GROUP = 1_000_000  # windows of a group that one task compares
GROUP_BYTES = 32_000_000  # and bytes of its suffixes
BATCH_ROWS = 20_000
PLACE_BITS = np.uint64(26)
PIECE = 1 << 22  # window starts; their places fit into PLACE_BITS


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM-byte strings, by doubling."""
    out, size = data.astype(np.uint64), 1
    while size < GRAM:
        out = mixed(out[:-size] * FACTOR + out[size:] + np.uint64(size))
        size *= 2
    return out


def _anchors(data: np.ndarray) -> np.ndarray:
    """The anchor of each window of at most PIECE + LENGTH - 1 bytes."""
    hashes = gram_hashes(data)
    place = np.arange(len(hashes), dtype=np.uint64)
    least = np.concatenate([(hashes >> PLACE_BITS) << PLACE_BITS | place, np.full(-len(hashes) % WINDOWS, np.iinfo(np.uint64).max, np.uint64)])
    blocks = least.reshape(-1, WINDOWS)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(data) - LENGTH + 1
    return (np.minimum(back[:n], ahead[WINDOWS - 1 : WINDOWS - 1 + n]) & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)


def units(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchors, borders): unit k has the window starts from borders[k] to borders[k + 1] and its anchor at anchors[k].

    Long texts are taken in pieces of PIECE window starts, with places counted in each, so any length is right.
    """
    n = max(0, len(data) - LENGTH + 1)
    anchors, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, n, PIECE):
        anchor = _anchors(data[at : at + PIECE + LENGTH - 1])
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        anchors.append(anchor[first] + at)
        starts.append(first + at)
    anchors, starts = np.concatenate(anchors), np.concatenate(starts)
    fresh = np.concatenate([[True], anchors[1:] != anchors[:-1]])[: len(anchors)]  # a unit may lie across two pieces
    return anchors[fresh], np.concatenate([starts[fresh], [n]])


def _signed(number: int) -> int:
    return number - (1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("key"))


def describe(docs: DataFrame) -> DataFrame:
    """(key, sizes, contents, grams): for the units of each document their window counts, and hashes of content and anchor string."""

    def run(batches):
        for part, texts in doc_slices(batches):
            key = part.column(part.schema.get_field_index("key"))
            sizes, contents, grams = [], [], []
            for text in texts:
                raw = text.encode() if text else b""
                anchors, borders = units(np.frombuffer(raw, np.uint8))
                lows, highs = borders[:-1].tolist(), borders[1:].tolist()
                sizes.append(np.diff(borders))
                contents.append([_signed(xxhash.xxh3_64_intdigest(raw[a : b + LENGTH - 1], m - a)) for m, a, b in zip(anchors.tolist(), lows, highs)])
                grams.append([_signed(xxhash.xxh3_64_intdigest(raw[m : m + GRAM])) for m in anchors.tolist()])
            yield pa.RecordBatch.from_arrays(
                [key, pa.array(sizes, pa.list_(pa.int32())), pa.array(contents, pa.list_(pa.int64())), pa.array(grams, pa.list_(pa.int64()))],
                ["key", "sizes", "contents", "grams"],
            )

    return _keyed(docs).select("key", "text").mapInArrow(run, "key bigint, sizes array<int>, contents array<bigint>, grams array<bigint>")


def _fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(content, head, size, string): anchor suffix, then the bytes before the anchor backwards, of each wanted unit.

    ``wanted`` is (key, place, content): the document and the number of the unit in it.
    """
    by_doc = wanted.groupBy("key").agg(F.collect_list(F.struct("place", "content")).alias("wanted"))
    rows = _keyed(docs).select("key", "text").join(by_doc, "key").select("text", "wanted")

    def run(batches):
        for part, texts in doc_slices(batches):
            out = []
            for text, some in zip(texts, part.column(part.schema.get_field_index("wanted")).to_pylist()):
                raw = text.encode()
                anchors, borders = units(np.frombuffer(raw, np.uint8))
                for one in some:
                    k = one["place"]
                    a, low, high = int(anchors[k]), int(borders[k]), int(borders[k + 1])
                    right, left = raw[a : high + LENGTH - 1], raw[low:a][::-1]
                    head = int.from_bytes(right[:7], "big")
                    out.append((one["content"], head, len(left), high - low, right + left))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                ["content", "head", "before", "size", "string"],
            )

    # copies of a document fetch the same unit more than once
    return rows.mapInArrow(run, "content bigint, head bigint, before int, size int, string binary").dropDuplicates(["content"])


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which the first ``known`` bytes are known already."""
    end = min(len(a), len(b))
    if a[known:end] == b[known:end]:
        return end
    low, step = known, 16
    while a[low : low + step] == b[low : low + step]:
        low += step
        step *= 2
    high = low + step
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Common prefix with the string before, length, and the remaining bytes, of sorted strings."""
    shared, before = [], b""
    for string in strings:
        shared.append(common_prefix(before, string))
        before = string
    rest = b"".join(s[n:] for s, n in zip(strings, shared))
    return np.array(shared, np.uint16 if max(map(len, strings), default=0) < 65536 else np.uint32), np.array(list(map(len, strings)), np.uint32), rest


class Run:
    """Decodes a front-coded run one string at a time."""

    def __init__(self, shared: np.ndarray, lengths: np.ndarray, rest: bytes, payload: list):
        self.shared, self.lengths, self.rest, self.payload = shared.tolist(), lengths.tolist(), rest, payload
        self.at, self.place, self.string = -1, 0, b""

    def advance(self) -> int:
        """Go to the next string; its common prefix with the one before, or -1 at the end."""
        self.at += 1
        if self.at == len(self.shared):
            return -1
        n, size = self.shared[self.at], self.lengths[self.at]
        self.string = self.string[:n] + self.rest[self.place : self.place + size - n]
        self.place += size - n
        return n


class LoserTree:
    """Merges front-coded runs. Each inner node keeps the loser of its match and how much the loser shares with the winner.

    Heads are compared by the prefix they share with the last string given out: the longer one is the smaller, and only
    on a draw are bytes compared, from that prefix on.
    """

    def __init__(self, runs: list[Run]):
        self.runs = runs
        self.size = 1 << max(0, (len(runs) - 1).bit_length())
        self.shared = [run.advance() for run in runs] + [-1] * (self.size - len(runs))
        self.shared = [min(n, 0) for n in self.shared]  # nothing has been given out yet
        self.loser = [-1] * self.size
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, self.loser[node] = self._match(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def _match(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two heads; afterwards the loser's prefix is the one it shares with the winner."""
        n, m = self.shared[a], self.shared[b]
        if n != m:
            return (a, b) if n > m else (b, a)
        if n < 0:
            return a, b
        x, y = self.runs[a].string, self.runs[b].string
        k = common_prefix(x, y, n)
        if x[k:] > y[k:]:
            a, b = b, a
        self.shared[b] = k
        return a, b

    def __iter__(self):
        """(run, common prefix with the string given out before)."""
        while self.shared[self.winner] >= 0:
            best = self.winner
            run = self.runs[best]
            yield run, self.shared[best]
            self.shared[best] = run.advance()
            node, now = (best + self.size) // 2, best
            while node:
                now, self.loser[node] = self._match(now, self.loser[node])
                node //= 2
            self.winner = now


def _runs(strings: DataFrame, splitters: list[int]) -> DataFrame:
    """(range, run, data...): sorted runs of a task, front-coded, cut at the splitters."""

    def run(batches):
        held, size, number = [], 0, 0

        def flush():
            nonlocal number
            held.sort()
            borders = np.searchsorted(np.array(splitters, np.int64), np.array([int.from_bytes(h[0][:7], "big") for h in held], np.int64), side="right")
            cuts = np.flatnonzero(np.concatenate([[True], borders[1:] != borders[:-1], [True]]))
            name = TaskContext.get().partitionId() << 20 | number
            number += 1
            for a, b in zip(cuts[:-1], cuts[1:]):
                some = held[a:b]
                shared, lengths, rest = front_coded([h[0] for h in some])
                payload = np.array([h[1:] for h in some], np.int64)
                data = shared.astype(np.uint32).tobytes() + lengths.tobytes() + payload.tobytes() + rest
                packed = zstandard.ZstdCompressor(level=3).compress(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(borders[a])], pa.int32()), pa.array([name]), pa.array([len(some)], pa.int32()), pa.array([packed], pa.binary())],
                    ["range", "run", "n", "data"],
                )
            held.clear()

        for batch in batches:
            for content, before, width, string in zip(*(batch.column(k).to_pylist() for k in range(4))):
                held.append((string, content, before, width))
                size += len(string)
                if size > RUN_BYTES:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    return strings.select("content", "before", "size", "string").mapInArrow(run, "range int, run bigint, n int, data binary")


def _packed_bits(numbers: list[int]) -> bytes:
    bits = np.zeros(WINDOWS, dtype=np.uint8)
    bits[numbers] = 1
    return np.packbits(bits).tobytes()


def _merged(runs: DataFrame, n_ranges: int, group_limit: int) -> DataFrame:
    """Rows with bits: content and its repeated windows. Rows with a hash: a window of a large group, not judged yet."""

    def members(runs):
        """(whether a group begins, unit, content, bytes before the anchor, distances from the anchor of the windows worth a look)."""

        def member(following):
            string, content, before, width, shared = last
            aheads = range(max(before - width + 1, LENGTH - max(shared, following), 0), before + 1)
            unit = string[len(string) - before :][::-1] + string[: len(string) - before]
            return not shared, unit, content, before, aheads

        last = None
        for run, shared in LoserTree(runs):
            shared = shared if shared >= GRAM else 0
            if last is not None:
                yield member(shared)
            last = (run.string, *run.payload[run.at], shared)
        if last is not None:
            yield member(0)

    def digest(unit: bytes, number: int) -> bytes:
        return xxhash.xxh3_128_digest(unit[number : number + LENGTH])

    def judged(group: list[tuple]):
        """Repeated windows of a whole group."""
        places: dict[int, list[int]] = {}  # members of the group by how far before the anchor they have a window
        for i, member in enumerate(group):
            for ahead in member[3]:
                places.setdefault(ahead, []).append(i)
        repeated: dict[int, bytearray] = {}
        for ahead, some in places.items():
            seen: dict[bytes, int] = {}
            for i in some:
                unit, _, before, _ = group[i]
                first = seen.setdefault(digest(unit, before - ahead), i)
                if first != i:
                    repeated.setdefault(i, bytearray(WINDOWS))[before - ahead] = 1
                    repeated.setdefault(first, bytearray(WINDOWS))[group[first][2] - ahead] = 1
        for i, bits in repeated.items():
            yield group[i][1], np.packbits(np.frombuffer(bits, np.uint8)).tobytes(), None, None

    def hashed(unit: bytes, content: int, before: int, aheads: range):
        """The windows of a member of a large group."""
        for ahead in aheads:
            yield content, None, before - ahead, digest(unit, before - ahead) + ahead.to_bytes(2, "big")

    def merge(runs):
        """A group above the limits is not held: what is there goes on as hashes, and so does each further member."""
        group: list[tuple] = []
        windows = size = 0
        large = False
        for begins, *member in members(runs):
            if begins:
                yield from judged(group)
                group, windows, size, large = [], 0, 0, False
            if large:
                yield from hashed(*member)
            elif member[3]:
                group.append(member)
                windows += len(member[3])
                size += len(member[0])
                if windows > group_limit or size > GROUP_BYTES:
                    large = True
                    for one in group:
                        yield from hashed(*one)
                    group = []
        yield from judged(group)

    def batched(rows):
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.binary())
        while some := list(islice(rows, BATCH_ROWS)):
            columns = [pa.array(column, kind) for column, kind in zip(zip(*some), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["content", "bits", "number", "digest"])

    def run(batches):
        ranges: dict[int, list[Run]] = {}
        for batch in batches:
            for part, _, n, packed in zip(*(c.to_pylist() for c in batch.columns)):
                data = zstandard.ZstdDecompressor().decompress(packed)
                payload = np.frombuffer(data, np.int64, 3 * n, 8 * n).reshape(-1, 3).tolist()
                ranges.setdefault(part, []).append(
                    Run(np.frombuffer(data, np.uint32, n), np.frombuffer(data, np.uint32, n, 4 * n), data[32 * n :], payload)
                )
        for part in sorted(ranges):
            yield from batched(merge(ranges.pop(part)))

    return runs.repartitionById(n_ranges, "range").mapInArrow(run, "content bigint, bits binary, number int, digest binary")


def repeated_windows(docs: DataFrame, group_limit: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(units of documents, (content, bits)): which windows of a content occur elsewhere; bits is null where all do."""
    described = store(describe(docs), "repeats-units")
    zipped = F.arrays_zip("contents", "grams")
    each = described.select("key", F.posexplode(zipped).alias("place", "unit")).select("key", "place", "unit.contents", "unit.grams")
    contents = each.groupBy("contents", "grams").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place")).alias("first"))
    contents = store(contents.withColumnsRenamed({"contents": "content", "grams": "gram"}), "repeats-contents")
    release(docs.sparkSession)
    grams = contents.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).where("m > 1 and least = 1").select("gram")
    grams = store(grams, "repeats-grams")
    wanted = contents.join(grams, "gram").select("first.key", "first.place", "content")
    strings = store(_fetch(docs, wanted), "repeats-strings")
    release(docs.sparkSession)
    size = strings.agg(F.sum(F.length("string")).alias("n")).first()["n"] or 0
    n_ranges = 1 + size // RANGE_BYTES
    cuts = [k / n_ranges for k in range(1, n_ranges)]
    splitters = sorted(set(strings.agg(F.percentile_approx("head", cuts, 10_000).alias("s")).first()["s"] or [])) if cuts else []
    merged = store(_merged(_runs(strings, splitters), len(splitters) + 1, group_limit), "repeats-merged")
    direct = merged.where("bits is not null").select("content", "bits")
    counted = merged.where("bits is null")
    twice = counted.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    twice = store(twice, "repeats-windows")
    numbers = counted.join(twice, "digest").groupBy("content").agg(F.sort_array(F.collect_set("number")).alias("numbers"))

    def packed(batches):
        for batch in batches:
            bits = [_packed_bits(numbers) for numbers in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], ["content", "bits"])

    some = direct.unionByName(numbers.mapInArrow(packed, "content bigint, bits binary"))
    whole = contents.where("n > 1").select("content", F.lit(None).cast("binary").alias("bits"))
    once = some.join(contents.where("n = 1").select("content"), "content", "left_semi")
    verdicts = store(once.unionByName(whole), "repeats-verdicts")
    discard(contents, grams, strings, merged, twice)
    release(docs.sparkSession)
    return described, verdicts


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps, which Spark's cleaner drops with the garbage that holds them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _removed(docs: DataFrame, described: DataFrame, verdicts: DataFrame, kept_text: bool) -> DataFrame:
    zipped = F.arrays_zip("sizes", "contents")
    each = described.select("key", F.posexplode(zipped).alias("place", "unit")).select("key", "place", F.col("unit.contents").alias("content"))
    hits = each.join(verdicts, "content").groupBy("key", "place").agg(F.first("bits").alias("bits"))
    hits = hits.groupBy("key").agg(F.collect_list(F.struct("place", "bits")).alias("hits"))
    kind = docs.schema["doc_id"].dataType
    rows = _keyed(docs).join(hits, "key", "left").select("doc_id", "text", "hits")
    fields = [StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [StructField("kept_sha256", StringType())]
    schema = StructType([StructField("doc_id", kind), *fields, *([StructField("kept_text", StringType())] if kept_text else [])])

    def run(batches):
        for part, texts in doc_slices(batches):
            out = []
            for text, some in zip(texts, part.column(part.schema.get_field_index("hits")).to_pylist()):
                raw = text.encode() if text else b""
                spans = covered(raw, some) if some else []
                kept, at = [], 0
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                rest = b"".join(kept) + raw[at:]
                row = (len(raw), len(raw) - len(rest), len(spans), hashlib.sha256(rest).hexdigest())
                out.append((*row, rest.decode("utf-8", "ignore")) if kept_text else row)
            columns = [pa.array([r[k] for r in out]) for k in range(len(schema) - 1)]
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("doc_id")), *columns], schema.names)

    return rows.mapInArrow(run, schema)


def covered(raw: bytes, hits: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of bytes inside repeated windows."""
    _, borders = units(np.frombuffer(raw, np.uint8))
    start = np.zeros(len(raw) + 1, dtype=np.int64)
    for hit in hits:
        low, high = int(borders[hit["place"]]), int(borders[hit["place"] + 1])
        if hit["bits"] is None:
            places = np.arange(low, high)
        else:
            bits = np.unpackbits(np.frombuffer(hit["bits"], np.uint8))
            places = low + np.flatnonzero(bits[: high - low])
        np.add.at(start, places, 1)
        np.add.at(start, places + LENGTH, -1)
    inside = np.concatenate([[0], np.cumsum(start) > 0]).astype(np.int8)
    edges = np.diff(inside)
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))


def query(docs: DataFrame, group_limit: int = GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per document."""
    docs = docs.select("doc_id", "text")
    return _removed(docs, *repeated_windows(docs, group_limit), kept_text=False)


def deduplicated(docs: DataFrame) -> DataFrame:
    """The result of ``query`` with the text that is left; characters cut apart by a removed run are dropped."""
    docs = docs.select("doc_id", "text")
    return _removed(docs, *repeated_windows(docs), kept_text=True)
