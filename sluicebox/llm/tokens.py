"""Token counts: pieces are counted once per distinct pre-token and summed by per-document frequencies.

Texts are cut into pre-tokens by the tokenizer's own normaliser and pre-tokenizer. Pre-tokens that are one piece of the
vocabulary are known at once. All others are exchanged by bucket of their hash, packed for many documents at a time (the
pre-tokens once, with document numbers and frequencies); each bucket counts the pieces of each distinct pre-token once,
turns frequencies into sums per document, and sends the sums back to their pack of documents. No ids are made.

Defined results: null and empty texts have no tokens; the strings of special tokens inside a text count as one token, as
in the library; repeated rows get equal results; an empty table gives no rows. Only doc_id and text are read, so other
columns may have any name.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from sluicebox.llm.common import doc_slices

LIMIT = 2048
PACK_PAIRS = 2_000_000
PACK_DOCS = 60_000
PACK_CHUNKS = 400_000
BUCKET_BYTES = 12_000_000


class PreTokens:
    """Pre-tokens of texts, and the piece count of a pre-token, by a tokenizers file."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(content)
        self.normalizer, self.pre_tokenizer, self.model = tokenizer.normalizer, tokenizer.pre_tokenizer, tokenizer.model
        added = [token.content.encode() for token in tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.plain, self.lower = _plain_pattern(json.loads(content))
        end = "</w>"
        words = (piece[: -len(end)] for piece in tokenizer.get_vocab(with_added_tokens=False) if piece.endswith(end))
        self.single = frozenset(word for word in words if word and self.pieces(word) == 1)

    def pieces(self, pre_token: str) -> int:
        return len(self.model.tokenize(pre_token))

    def cut(self, chunk: bytes) -> list[str]:
        text = chunk.decode()
        if self.plain and text.isascii() and text.isprintable():
            return self.plain.findall(text.lower() if self.lower else text)
        normal = self.normalizer.normalize_str(text) if self.normalizer else text
        return [word for word, _ in self.pre_tokenizer.pre_tokenize_str(normal)]

    def segments(self, text: bytes) -> list[bytes]:
        """What lies between the special tokens of a text."""
        return self.special.split(text) if self.special else [text]


def _plain_pattern(spec: dict) -> tuple[re.Pattern | None, bool]:
    """The split pattern as it reads on printable ASCII without blanks, and whether texts are lower-cased before it.

    None where the file has steps that this cannot say; then the library cuts every chunk.
    """

    def steps(part: dict | None, inner: str) -> list[dict]:
        return part[inner] if part and part["type"] == "Sequence" else [part] if part else []

    forms = steps(spec.get("normalizer"), "normalizers")
    cuts = steps(spec.get("pre_tokenizer"), "pretokenizers")
    neutral = all(
        form["type"] in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase") or (form["type"] == "Replace" and form["pattern"] == {"Regex": r"\s+"}) for form in forms
    )
    if not neutral or [cut["type"] for cut in cuts] != ["Split", "ByteLevel"]:
        return None, False
    split, tail = cuts
    if split["behavior"] != "Removed" or not split["invert"] or "Regex" not in split["pattern"] or tail["use_regex"] or tail["add_prefix_space"]:
        return None, False
    pattern = split["pattern"]["Regex"].replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")
    if re.search(r"\\[^s]|\(|\[\[|&&", pattern):
        return None, False
    return re.compile(pattern), any(form["type"] == "Lowercase" for form in forms)


class _Chunks(dict):
    """Numbers of the chunks between blanks; of each, its one-piece pre-tokens (counted) and its others (numbered).

    No pre-token and no normal form reaches over a blank, so each distinct chunk is cut once.
    """

    def __init__(self, source: PreTokens):
        super().__init__()
        self.source, self.known = source, array("q")
        self.words: dict[str, int] = {}
        self.open, self.begins = array("i"), array("q", [0])

    def __missing__(self, chunk: bytes) -> int:
        self[chunk] = number = len(self)
        known, words = 0, self.words
        for word in self.source.cut(chunk):
            if word in self.source.single:
                known += 1
            else:
                self.open.append(words.setdefault(word, len(words)))
        self.known.append(known)
        self.begins.append(len(self.open))
        return number


@lru_cache(maxsize=1)
def _pre_tokens(content: str) -> PreTokens:
    return PreTokens(content)


def _packed(arrays: list[np.ndarray]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.tobytes() for a in arrays))


def _packs(docs: DataFrame, content: str, n_buckets: int, schema: StructType) -> DataFrame:
    """Rows of kind 0: a pack's documents with what is known of them. Rows of kind 1: a pack's other pre-tokens of a bucket."""

    def run(batches):
        source, chunks = _pre_tokens(content), None
        ids, sizes, special, lengths, numbers, times = [], [], [], [], [], []
        number = held = 0

        def flush():
            nonlocal number
            pack = xxhash.xxh3_64_intdigest(f"{TaskContext.get().partitionId()}:{number}") >> 1
            number += 1
            known, posts = _postings(chunks, lengths, numbers, times)
            known += np.array(special, dtype=np.int64)
            rows = [(pack % n_buckets, pack, 0, pa.concat_arrays(ids), list(sizes), known.tolist(), 0, None, None)]
            for bucket, tokens, many, doc, time in _by_bucket(list(chunks.words), posts, n_buckets):
                text = zstandard.ZstdCompressor(level=3).compress("\n".join(tokens).encode())
                rows.append((bucket, pack, 1, None, None, None, len(tokens), text, _packed([many, doc.astype(np.uint16), time])))
            for kept in (ids, sizes, special, lengths, numbers, times):
                kept.clear()
            yield _batch(rows, schema)

        for part, texts in doc_slices(batches):
            chunks = _Chunks(source) if chunks is None else chunks
            ids.append(part.column(part.schema.get_field_index("doc_id")))
            for text in texts:
                raw = text.encode() if text else b""
                segments = source.segments(raw)
                found = Counter(segments[0].split())
                for segment in segments[1:]:
                    found.update(segment.split())
                numbers.append(np.fromiter(map(chunks.__getitem__, found), np.int32, len(found)))
                times.append(np.fromiter(found.values(), np.uint32, len(found)))
                sizes.append(len(raw))
                special.append(len(segments) - 1)
                lengths.append(len(found))
                held += len(found)
            if held > PACK_PAIRS or len(sizes) > PACK_DOCS - 256 or len(chunks) > PACK_CHUNKS:
                yield from flush()
                chunks, held = None, 0
        if sizes:
            yield from flush()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _postings(chunks: _Chunks, lengths: list, numbers: list, times: list) -> tuple[np.ndarray, tuple]:
    """Known pieces per document of a pack, and (word number, document number, frequency) of the other pre-tokens."""
    n = len(lengths)
    chunk, many = np.concatenate(numbers), np.concatenate(times)
    doc = np.repeat(np.arange(n, dtype=np.int32), lengths)
    known = np.bincount(doc, np.frombuffer(chunks.known, np.int64)[chunk] * many.astype(np.int64), minlength=n) if len(doc) else np.zeros(n)
    begins = np.frombuffer(chunks.begins, np.int64)
    some = np.diff(begins)[chunk] > 0
    chunk, many, doc = chunk[some], many[some], doc[some]
    size = np.diff(begins)[chunk]
    at = np.repeat(begins[chunk] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    word = np.frombuffer(chunks.open, np.int32)[at] if len(at) else np.zeros(0, np.int32)
    return known.astype(np.int64), (word, np.repeat(doc, size), np.repeat(many, size))


def _by_bucket(words: list[str], posts: tuple, n_buckets: int):
    """(bucket, its pre-tokens in order, documents of each, document numbers, frequencies); a document has a pre-token once."""
    word, doc, times = posts
    if not len(word):
        return
    bucket = np.fromiter((zlib.crc32(w.encode()) % n_buckets for w in words), np.int64, len(words))
    names = np.empty(len(words), dtype=np.int64)
    names[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((names, bucket))
    rank = np.empty(len(words), dtype=np.int64)
    rank[order] = np.arange(len(words))
    key = rank[word] << 16 | doc  # a pack has under 2 ** 16 documents
    by_key = np.argsort(key)
    key, times = key[by_key], times[by_key]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    key, times = key[first], np.add.reduceat(times, first, dtype=np.uint32)
    many = np.bincount(key >> 16, minlength=len(words)).astype(np.uint32)
    ends = np.concatenate([[0], np.cumsum(many, dtype=np.int64)])
    borders = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0, [True]]))
    for a, b in zip(borders[:-1], borders[1:]):
        span = slice(ends[a], ends[b])
        yield int(bucket[order[a]]), [words[k] for k in order[a:b]], many[a:b], key[span] & 0xFFFF, times[span]


def _batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)
    columns = []
    for k, field in enumerate(target):
        values = [row[k] for row in rows]
        if isinstance(next((v for v in values if v is not None), None), pa.Array):
            offsets = pa.array(np.concatenate([[0], np.cumsum([0 if v is None else len(v) for v in values])]).astype(np.int32))
            whole = pa.concat_arrays([v for v in values if v is not None])
            columns.append(pa.ListArray.from_arrays(offsets, whole))
        else:
            columns.append(pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(columns, target.names)


def _counted(packs: DataFrame, content: str, n_buckets: int) -> DataFrame:
    """Kind 1 rows become sums of pieces per document of the pack: document numbers, then sums."""
    schema = packs.schema

    def run(batches):
        source, counts, current = _pre_tokens(content), {}, None
        for batch in batches:
            rows = []
            columns = [batch.column(k) for k in range(batch.num_columns)]
            for i in range(batch.num_rows):
                row = [c[i].as_py() if k != 3 else c[i].values for k, c in enumerate(columns)]
                if row[2] == 1:
                    if row[0] != current:
                        counts, current = {}, row[0]
                    tokens = zstandard.ZstdDecompressor().decompress(row[7]).decode().split("\n")
                    for token in set(tokens).difference(counts):
                        counts[token] = source.pieces(token)
                    raw = zstandard.ZstdDecompressor().decompress(row[8])
                    many = np.frombuffer(raw, np.uint32, len(tokens))
                    n = int(many.sum())
                    docs = np.frombuffer(raw, np.uint16, n, 4 * len(tokens))
                    times = np.frombuffer(raw, np.uint32, n, 4 * len(tokens) + 2 * n)
                    pieces = np.repeat(np.fromiter(map(counts.__getitem__, tokens), np.int64, len(tokens)), many)
                    sums = np.bincount(docs, pieces * times).astype(np.int64)
                    some = np.flatnonzero(sums)
                    row[6], row[7], row[8] = len(some), None, _packed([some.astype(np.uint16), sums[some]])
                rows.append(row)
            if rows:
                yield _batch(rows, schema)

    by_bucket = packs.repartitionById(n_buckets, "bucket").sortWithinPartitions("bucket")
    return by_bucket.mapInArrow(run, schema)


def count_tokens(docs: DataFrame, content: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per document; ``content`` is the tokenizers file, under 2 MB."""
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n_buckets = 1 + total // BUCKET_BYTES
    kind = docs.schema["doc_id"].dataType
    schema = StructType.fromDDL("bucket int, pack bigint, kind int").add(StructField("ids", ArrayType(kind)))
    schema = StructType([*schema, *StructType.fromDDL("sizes array<bigint>, known array<bigint>, n int, tokens binary, data binary")])
    sums = _counted(_packs(docs, content, n_buckets, schema), content, n_buckets)
    result = StructType([StructField("doc_id", kind), StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])

    def run(batches):
        ids = sizes = known = None

        def done():
            if ids is not None:
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(known)], result.names)

        for batch in batches:
            columns = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                if columns["kind"][i].as_py() == 0:
                    yield from done()
                    ids = columns["ids"][i].values
                    sizes, known = columns["sizes"][i].as_py(), np.array(columns["known"][i].as_py(), dtype=np.int64)
                else:
                    n = columns["n"][i].as_py()
                    raw = zstandard.ZstdDecompressor().decompress(columns["data"][i].as_py())
                    known[np.frombuffer(raw, np.uint16, n)] += np.frombuffer(raw, np.int64, n, 2 * n)
        yield from done()

    return sums.repartition("pack").sortWithinPartitions("pack", "kind").mapInArrow(run, result)


def query(docs: DataFrame, content: str) -> DataFrame:
    return count_tokens(docs, content).withColumn("over_limit", F.col("n_tokens") > LIMIT)
