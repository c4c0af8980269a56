"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

Pairs of adjacent symbols that form a piece wait in an agenda ordered by the piece's score, the
leftmost first among equals; the best is merged and its new neighbours enter, until the agenda is
empty. Symbols that are no piece become byte pieces, or the unknown id where a model has none.

Two characters that stand side by side in no piece can never be merged across, so a text falls into
segments at such places and every segment has its own agenda. That is exact for any vocabulary, and
segments repeat, so a worker remembers them. In each Arrow batch all segments met for the first time
are also encoded by the sentencepiece library, in one call; a difference stops the job. Decoding is
the library's.

Defined results: a null or empty text has no ids; ids of control pieces never arise, their names in
a text are ordinary text; repeated rows each give a row; a text is read in windows, so a very long
one needs memory for its ids only; a segment of any length takes n log n steps; extra columns are
ignored, whatever their names; an empty table gives an empty result. Models of another type than
BPE, with a normaliser of their own, or with pieces defined by the user or unused, are refused.
"""

from __future__ import annotations

import functools
import heapq
import struct
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, functions as F

from eventindex.llm.common import text_or_empty

SPACE = "▁"        # fixed value: how the models write a space
FENCE = "\n"            # put before a segment when the library encodes it alone
CACHE = 800_000         # segments remembered by a Python worker, about 250 bytes each
REMEMBERED = 64         # longest segment remembered, in characters
WINDOW = 1 << 20        # characters cut into segments at once
KNOWN = 1_024           # code points with a place of their own in the table of neighbours
SHORT = 24              # symbols up to which the agenda is a plain list
FLUSH = 1 << 20         # ids per batch handed back

# fixed values: numbers of the fields, types and defaults in a serialized model
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE_MODEL = 2


def fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """Numbers and values of the fields of one protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        value = raw[at:at + size]
        at += size
        yield number, struct.unpack("<f", value)[0] if kind == 5 else value


class Vocabulary:
    """Pieces, scores and settings of a model file."""

    def __init__(self, raw: bytes):
        ids, kinds = {}, []
        self.score: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.unknown = 0
        trainer, normalizer = {}, {}
        for number, value in fields(raw):
            if number == PIECES:
                piece = {1: b"", 2: 0.0, 3: NORMAL} | dict(fields(value))
                text, kind = piece[1].decode("utf-8"), piece[3]
                if kind == NORMAL:
                    ids[text] = len(kinds)
                    self.score[text] = piece[2]
                elif kind == BYTE:
                    self.bytes[int(text[3:5], 16)] = len(kinds)
                elif kind == UNKNOWN:
                    self.unknown = len(kinds)
                elif kind != CONTROL:
                    raise ValueError("pieces defined by the user or unused are not supported")
                kinds.append(kind)
            elif number == TRAINER:
                trainer = dict(fields(value))
            elif number == NORMALIZER:
                normalizer = dict(fields(value))
        if trainer.get(3, 1) != BPE_MODEL or trainer.get(24, 0):
            raise ValueError("not a merge-type model with white space before words")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("models with a normaliser of their own are not supported")
        self.ids = ids
        self.prefix = SPACE if normalizer.get(3, 1) else ""
        self.fallback = len(self.bytes) == 256 and trainer.get(35, 0)
        self.apart = self._apart(ids)

    @staticmethod
    def place(codes: np.ndarray) -> np.ndarray:
        """Row of each code point in the table of neighbours; the last row is for all others."""
        return np.where(codes == ord(SPACE), 0, np.minimum(codes, KNOWN))

    def _apart(self, ids: dict[str, int]) -> np.ndarray:
        """May two characters be cut apart, as they are adjacent in no piece?"""
        apart = np.ones((KNOWN + 1, KNOWN + 1), bool)
        for piece in ids:
            codes = self.place(np.frombuffer(piece.encode("utf-32-le"), np.uint32))
            apart[codes[:-1], codes[1:]] = False
        return apart

    def segments(self, text: str) -> Iterator[list[str]]:
        """The segments of a normalised text, window by window."""
        start, width = 0, WINDOW
        while start < len(text):
            part = text[start:start + width]
            codes = self.place(np.frombuffer(part.encode("utf-32-le"), np.uint32))
            cuts = np.flatnonzero(self.apart[codes[:-1], codes[1:]]) + 1
            last = start + len(part) >= len(text)
            if not last and not len(cuts):
                width *= 2
                continue
            ends = [*cuts.tolist(), len(part)] if last else cuts.tolist()
            yield [part[a:b] for a, b in zip([0, *ends], ends)]
            start, width = start + ends[-1], WINDOW

    def normalise(self, text: str) -> str:
        return self.prefix + text.replace(" ", SPACE) if text else ""

    def encode(self, segment: str) -> tuple[int, ...]:
        """Ids of one segment."""
        if segment in self.ids and len(segment) == 1:
            return (self.ids[segment],)
        symbols = (short_agenda if len(segment) <= SHORT else agenda)(segment, self.score)
        out: list[int] = []
        unknown = False
        for s in symbols:
            found = self.ids.get(s)
            if found is not None:
                out.append(found)
            elif self.fallback:
                out.extend(self.bytes[b] for b in s.encode("utf-8"))
            elif not unknown:  # neighbouring unknown symbols count as one
                out.append(self.unknown)
            unknown = found is None
        return tuple(out)


def short_agenda(segment: str, score: dict[str, float]) -> list[str]:
    """The agenda as a list in text order: its best entry is the first of the largest score."""
    symbols, get, none = list(segment), score.get, float("-inf")
    waiting = [get(a + b, none) for a, b in zip(symbols, symbols[1:])]
    while waiting and (best := max(waiting)) > none:
        i = waiting.index(best)
        symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        del waiting[i]
        if i < len(waiting):
            waiting[i] = get(symbols[i] + symbols[i + 1], none)
        if i:
            waiting[i - 1] = get(symbols[i - 1] + symbols[i], none)
    return symbols


def agenda(segment: str, score: dict[str, float]) -> list[str]:
    """The agenda as a heap, with linked neighbours."""
    n = len(segment)
    symbols: list[str | None] = list(segment)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(-found, i, 2) for i in range(n - 1)
            if (found := score.get(segment[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        left, j = symbols[i], after[i]
        if left is None or j >= n or len(left) + len(symbols[j]) != size:
            continue  # one side has been merged since
        symbols[i], symbols[j] = left + symbols[j], None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n:
                pair = symbols[k] + symbols[after[k]]
                if (found := score.get(pair)) is not None:
                    heapq.heappush(heap, (-found, k, len(pair)))
    return [s for s in symbols if s is not None]


class Encoder(dict):
    """Segments to their ids; forgets when full. New ones are listed until they are checked."""

    def __init__(self, vocabulary: Vocabulary, library, limit: int = CACHE):
        super().__init__()
        self.vocabulary, self.library, self.limit = vocabulary, library, limit
        self.new: list[tuple[str, tuple[int, ...]]] = []
        self.fence = len(library.encode(FENCE))

    def __missing__(self, segment: str) -> tuple[int, ...]:
        ids = self.vocabulary.encode(segment)
        self.new.append((segment, ids))
        if len(segment) <= REMEMBERED:
            if len(self) >= self.limit:
                self.clear()
            self[segment] = ids
        return ids

    def text(self, text: str) -> list[int]:
        ids: list[int] = []
        for parts in self.vocabulary.segments(self.vocabulary.normalise(text)):
            ids.extend(chain.from_iterable(map(self.__getitem__, parts)))
        return ids

    def check(self) -> None:
        """Compare the new segments with the library."""
        found = self.library.encode([FENCE + s for s, _ in self.new], num_threads=1)
        for (segment, ids), other in zip(self.new, found):
            if tuple(other[self.fence:]) != ids:
                raise RuntimeError(f"sentencepiece differs on {segment[:200]!r}")
        self.new.clear()


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker."""
    import sentencepiece

    with open(path, "rb") as model:
        vocabulary = Vocabulary(model.read())
    fence = vocabulary.place(np.array([ord(FENCE)]))
    if not (vocabulary.apart[fence].all() and vocabulary.apart[:, fence].all()):
        raise ValueError("the line end is part of a longer piece")
    return Encoder(vocabulary, sentencepiece.SentencePieceProcessor(model_file=path))


def encode_task(path: str) -> Callable:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text", pa.string())])
        coder = encoder(path)

        def batch_of(docs: list, ids: list):
            coder.check()
            return pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(coder.library.decode(ids) if ids else [], pa.string())], schema=schema)

        for batch in batches:
            docs, ids, size = [], [], 0
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                docs.append(doc.as_py())
                ids.append(coder.text(text.as_py()))
                size += len(ids[-1])
                if size > FLUSH:
                    yield batch_of(docs, ids)
                    docs, ids, size = [], [], 0
            yield batch_of(docs, ids)
    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>) and text (decoded from the ids), per row of docs."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(encode_task(path), "doc_id bigint, ids array<int>, text string")


def digests(encoded: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                          F.sha2(ids, 256).alias("ids_sha256"),
                          F.sha2("text", 256).alias("decoded_sha256"))
