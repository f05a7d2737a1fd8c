"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives one Viterbi pass.

The automaton reads a text once; at each position its output links name every piece that ends there, and each of them
may extend the best path of the position where it begins. What "best" means depends on the model file:

* unigram models: the highest sum of scores, ties to the longer last piece;
* BPE models: a piece extends a path only if merging would leave it and the path's last piece side by side as they are.
  A prefix of a merge result is the merge result of that prefix, so exactly one piece qualifies at each position and the
  pass gives the ids that merging gives. A sum of scores does not, as the scores of such a file are merge ranks.

No piece holds a space mark behind another character, so texts are cut before runs of space marks and each distinct
segment is encoded once per task.

Defined results: null and empty texts have no ids and decode to empty text; characters without a piece become byte pieces
(or one unknown id per run, where the model has no byte pieces); U+2581 in a text reads as a space, as in the library;
repeated rows get equal results. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
from pyspark.sql.types import BooleanType, LongType, StringType

from sluicebox.llm.common import doc_slices

SPACE = "▁"
CACHE_SEGMENTS = 300_000
CACHE_PAIRS = 250_000
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNKNOWN_PENALTY = 10.0


class PieceModel:
    """Pieces and scores of a SentencePiece model file; encodes and decodes single texts."""

    def __init__(self, content: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(content)
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("Only models that leave texts as they are, but for space marks, can be read")
        if trainer.model_type not in (UNIGRAM, BPE):
            raise ValueError(f"Unknown model type {trainer.model_type}")
        self.unigram = trainer.model_type == UNIGRAM
        self.dummy = SPACE if spec.add_dummy_prefix else ""
        self.pieces = [piece.piece for piece in proto.pieces]
        self.scores = [piece.score for piece in proto.pieces]
        kinds = [piece.type for piece in proto.pieces]
        self.ids = {piece: i for i, piece in enumerate(self.pieces) if kinds[i] in (NORMAL, USER)}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("A piece holds a space mark behind another character")
        if USER in kinds:
            raise ValueError("User-defined pieces are not supported")
        self.bytes = {int(self.pieces[i][3:5], 16): i for i, kind in enumerate(kinds) if kind == BYTE}
        self.unknown = kinds.index(UNKNOWN)
        self.unknown_score = min((s for s, k in zip(self.scores, kinds) if k == NORMAL), default=0.0) - UNKNOWN_PENALTY
        self.raw = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p.replace(SPACE, " ").encode()
            for p, k in zip(self.pieces, kinds)
        ]
        self.sizes = [len(piece) for piece in self.pieces]
        self.beside: list[dict[int, bool]] = [{} for _ in self.pieces]
        self.pairs = 0
        self.spines: dict[int, tuple[list, list]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.unigram or self._merge(piece)[0] == [piece]:
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.cut = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.segments = _Segments(self)

    def encode(self, text: str | None) -> list[int]:
        return self.encode_packed(text).tolist()

    def encode_packed(self, text: str | None) -> np.ndarray:
        """The ids of a text, as 32-bit numbers."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        known = self.segments
        if len(known) > CACHE_SEGMENTS:
            known.clear()
        ids = np.frombuffer(b"".join([known[s] for s in self.cut.findall(self.dummy + text.replace(" ", SPACE))]), np.int32)
        if not self.bytes:
            again = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)
            ids = ids[np.concatenate([[True], ~again])]
        return ids

    def decode(self, ids: list[int]) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy and text.startswith(" ") else text

    def encode_segment(self, segment: str) -> list[int]:
        """One pass over a segment: the last piece of the best path to each position, then the way back."""
        pieces = self._best_sums(segment) if self.unigram else self._merged(segment)
        ids: list[int] = []
        sizes, end = self.sizes, len(segment)
        while end:
            piece = pieces[end]
            if piece >= 0:
                ids.append(piece)
                end -= sizes[piece]
                continue
            end -= 1
            if self.bytes:
                ids.extend(self.bytes[b] for b in reversed(segment[end].encode()))
            else:
                ids.append(self.unknown)
        ids.reverse()
        return ids

    def _best_sums(self, segment: str) -> list[int]:
        n = len(segment)
        pieces, best = [-1] * (n + 1), [float("-inf")] * (n + 1)
        best[0], at = 0.0, 0
        for last, (piece, size) in self.automaton.iter(segment):
            while at < last:  # positions that nothing but an unknown character reaches
                at += 1
                if pieces[at] < 0:
                    best[at] = best[at - 1] + self.unknown_score
            k = last + 1
            score = best[k - size] + self.scores[piece]
            if score > best[k]:
                best[k], pieces[k] = score, piece
            if size > 1 and best[last] + self.unknown_score > best[k] and segment[last] not in self.ids:
                best[k], pieces[k] = best[last] + self.unknown_score, -1
        return pieces

    def _merged(self, segment: str) -> list[int]:
        pieces, reached, beside = [-1] * (len(segment) + 1), 0, self.beside
        for last, (piece, size) in self.automaton.iter(segment):
            if last < reached:
                continue
            left = pieces[last + 1 - size]
            if left >= 0:
                try:
                    stays = beside[left][piece]
                except KeyError:
                    stays = self._stay(left, piece)
                if not stays:
                    continue
            reached = last + 1
            pieces[reached] = piece
        return pieces

    def _stay(self, left: int, right: int) -> bool:
        """Whether merging the text of two neighbouring pieces gives these two pieces again.

        It does not if, at the moment a piece across the border would be merged, both its halves already stand there and
        neither has been taken up by its own side yet.
        """
        if self.pairs > CACHE_PAIRS:
            for row in self.beside:
                row.clear()
            self.pairs = 0
        ends, begins = self._spines(left)[1], self._spines(right)[0]
        if ends is None or begins is None:
            a, b = self.pieces[left], self.pieces[right]
            stays = self._merge(a + b)[0] == [a, b]
        else:
            stays, ids, scores = True, self.ids, self.scores
            for x, x_made, x_taken in ends:
                for y, y_made, y_taken in begins:
                    across = ids.get(x + y)
                    if across is None:
                        continue
                    score = scores[across]  # at equal scores the merge further left comes first
                    if min(x_made, y_made) > score and score > x_taken and score >= y_taken:
                        stays = False
        self.beside[left][right] = stays
        self.pairs += 1
        return stays

    def _spines(self, piece: int) -> tuple[list | None, list | None]:
        """What stands at the left and at the right border while a piece is merged: (text, score when made, score when taken up).

        None for pieces made by merges of equal scores, whose order depends on the place.
        """
        if piece not in self.spines:
            _, made = self._merge(self.pieces[piece])
            if len(set(score for _, score in made)) < len(made):
                self.spines[piece] = (None, None)
            else:
                self.spines[piece] = tuple(self._border(self.pieces[piece], made, side) for side in (0, -1))
        return self.spines[piece]

    @staticmethod
    def _border(text: str, made: list, side: int) -> list[tuple[str, float, float]]:
        out, now, since = [], text[side], float("inf")
        for parts, score in made:
            if parts[side] != now:
                out.append((now, since, score))
                now, since = parts[side], score
        return [*out, (now, since, float("-inf"))]

    def _merge(self, text: str) -> tuple[list[str], list[tuple[list[str], float]]]:
        """Plain merging of the best-scored adjacent pair, leftmost first, and the state after each merge.

        Only ever called on one or two pieces.
        """
        parts, made = list(text), []
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, at = self.scores[piece], i
            if at < 0:
                return parts, made
            parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]
            made.append((parts, best))


class _Segments(dict):
    """The ids of segments, packed."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model

    def __missing__(self, segment: str) -> bytes:
        packed = array("i", self.model.encode_segment(segment)).tobytes()
        if len(segment) <= 64:
            self[segment] = packed
        return packed


@lru_cache(maxsize=1)
def _model(content: bytes) -> PieceModel:
    """One model per Python worker."""
    return PieceModel(content)


def encode(docs: DataFrame, content: bytes) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): the ids of each whole text, and whether decoding gives the text back.

    ``content`` is the model file itself, a few hundred kB.
    """
    fields = [
        StructField("n_tokens", LongType()),
        StructField("ids", ArrayType(IntegerType())),
        StructField("round_trip", BooleanType()),
    ]
    schema = StructType([docs.schema["doc_id"], *fields])

    def run(batches):
        model = _model(content)
        for part, texts in doc_slices(batches):
            found = [model.encode_packed(text) for text in texts]
            sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = np.concatenate(found)
            same = [model.decode(ids.tolist()) == (text or "").replace(SPACE, " ") for ids, text in zip(found, texts)]
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("doc_id")), pa.array(sizes), ids, pa.array(same)], schema.names
            )
        model.segments.clear()  # the model outlives the task in its Python worker, what it has read should not

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(tokens: DataFrame, content: bytes) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give null."""
    schema = StructType([tokens.schema["doc_id"], StructField("text", StringType())])

    def run(batches):
        model = _model(content)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [None if ids is None else model.decode(ids) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], schema.names)

    return tokens.select("doc_id", "ids").mapInArrow(run, schema)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()
