"""Byte-level BPE over overlapping chunks.

A text is cut into chunks that overlap. Chunks are pre-tokenised on their own, in parallel. The
pattern looks ahead but never back, so from any position at which two chunks both start a
pre-token they agree: two neighbours are stitched at such a position inside their overlap. Each
chunk encodes its pre-tokens and gives the ids from its left stitch to its right one. A pre-token
that touches the end of a chunk, or could go on there, is never used for stitching. Where an
overlap has no common boundary (a pre-token as long as the overlap), the text is put together and
encoded in one piece, which is exact as well.

A text of one chunk needs no stitching and stays in its task; the chunks of longer texts meet by
text, so a group is as large as its text and no larger.

Defined results: a null text counts as empty and gives no ids; control strings are ordinary text;
lone surrogates cannot occur in Spark strings; repeated rows each give a row; extra columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, functions as F

from eventindex.llm.common import text_or_empty

CHUNK = 16_384      # characters that a chunk has to itself
OVERLAP = 1_024     # characters shared with the next chunk
# a pre-token is settled if so many characters of its chunk follow it: the pattern looks one ahead,
# and contractions are read up to two characters on
MARGIN = 4
CACHE = 200_000     # pre-tokens remembered by a Python worker

ENCODED = ("uid bigint, chunk int, chunks int, doc_id bigint, ids binary, raw binary, part string, "
           "head_at array<int>, head_id array<int>, tail_at array<int>, tail_id array<int>")


@functools.lru_cache(2)
def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a .tiktoken file: one line per token, base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


@functools.lru_cache(2)
def token_list(path: str) -> list[bytes]:
    """Bytes of each id."""
    ranks = load_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank is merged first, the leftmost among
    equals, until no pair has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i:i + 1] for i in range(len(piece))]
    if len(parts) > 200:
        return merge_long(parts, ranks)
    none = len(ranks) + 1
    pair = [ranks.get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
    while pair and (best := min(pair)) < none:
        i = pair.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i < len(pair):
            pair[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pair[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def merge_long(parts: list[bytes], ranks: dict[bytes, int]) -> list[int]:
    """As merge, with a heap and linked neighbours: n log n for pre-tokens of any length."""
    import heapq

    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, len(parts[i]) + len(parts[i + 1])) for i in range(n - 1)
            if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or len(parts[i]) + len(parts[j]) != size:
            continue  # one side has been merged since
        parts[i] += parts[j]
        alive[j] = False
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for left in (before[i], i):
            if left >= 0 and (right := after[left]) < n:
                r = ranks.get(parts[left] + parts[right])
                if r is not None:
                    heapq.heappush(heap, (r, left, len(parts[left]) + len(parts[right])))
    return [ranks[parts[i]] for i in range(n) if alive[i]]


class Encoder(dict):
    """Pre-token to its ids as little-endian 32-bit words; forgets when full."""

    def __init__(self, ranks: dict[bytes, int], limit: int = CACHE):
        super().__init__()
        self.ranks, self.limit = ranks, limit

    def __missing__(self, piece: str) -> bytes:
        ids = merge(piece.encode("utf-8"), self.ranks)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = packed
        return packed


def decode(ids: bytes, tokens: list[bytes]) -> bytes:
    """The raw bytes of packed ids, joined."""
    return b"".join(map(tokens.__getitem__, memoryview(ids).cast("I"))) if ids else b""


def boundaries(pieces: list[str], start: int) -> list[int]:
    at, out = start, []
    for p in pieces:
        out.append(at)
        at += len(p)
    return out


def chunk_rows(docs: DataFrame, id_col: str, text_col: str, chunk: int, overlap: int) -> DataFrame:
    """One row per chunk: uid (of the row of docs), chunk, chunks, start, part, last."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       text_or_empty(text_col).alias("text"),
                       F.monotonically_increasing_id().alias("uid"))
    chunks = F.greatest(F.lit(1), F.ceil(F.length("text") / chunk)).cast("int")
    return (rows.withColumn("chunks", chunks)
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("uid", "doc_id", "chunk", "chunks", (F.col("chunk") * chunk).alias("start"),
                    F.when(F.col("chunks") == 1, F.col("text")).otherwise(
                        F.substring("text", F.col("chunk") * chunk + 1, F.lit(chunk + overlap)))
                    .alias("part")))


def encode_chunks(path: str, pattern: str, chunk: int, overlap: int) -> Callable:
    """The function for mapInArrow: chunk rows to ENCODED rows."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import regex

        find, encoder, tokens = regex.compile(pattern).findall, Encoder(load_ranks(path)), token_list(path)
        schema = pa.schema([
            ("uid", pa.int64()), ("chunk", pa.int32()), ("chunks", pa.int32()),
            ("doc_id", pa.int64()), ("ids", pa.binary()), ("raw", pa.binary()),
            ("part", pa.string()), *((c, pa.list_(pa.int32())) for c in ("head_at", "head_id", "tail_at", "tail_id"))])
        for batch in batches:
            cols = {c: batch.column(c).to_pylist()
                    for c in ("uid", "chunk", "chunks", "doc_id", "start", "part")}
            out = {f: [] for f in schema.names}
            for uid, no, of, doc, start, part in zip(*cols.values()):
                pieces = find(part)
                packed = list(map(encoder.__getitem__, pieces))
                ids = b"".join(packed)
                ends = ([], [], [], [])
                if of > 1:
                    ends = stitching(pieces, packed, start, len(part), no, of, chunk, overlap)
                row = (uid, no, of, doc, ids, decode(ids, tokens) if of == 1 else None,
                       part if of > 1 else None, *ends)
                for f, v in zip(out, row):
                    out[f].append(v)
                if len(out["uid"]) >= 2_000:
                    yield pa.RecordBatch.from_pydict(out, schema)
                    out = {f: [] for f in schema.names}
            yield pa.RecordBatch.from_pydict(out, schema)
    return run


def stitching(pieces: list[str], packed: list[bytes], start: int, length: int, no: int, of: int,
              chunk: int, overlap: int) -> tuple[list[int], ...]:
    """Where pre-tokens start, and how many ids come before: in the overlap with the chunk before
    (head) and, as far as settled, in the overlap with the chunk after (tail)."""
    at = boundaries(pieces, start)
    before, n = [], 0
    for p in packed:
        before.append(n)
        n += len(p) // 4
    head = [k for k, x in enumerate(at) if no and x < start + overlap]
    settled = start + length - MARGIN
    tail = [k for k, x in enumerate(at) if no + 1 < of and start + chunk <= x
            and x <= settled]
    return ([at[k] for k in head], [before[k] for k in head],
            [at[k] for k in tail], [before[k] for k in tail])


def stitch(rows: list[dict]) -> bytes | None:
    """Ids of a text from its chunks in order; None where an overlap has no common boundary."""
    out, from_id = [], 0
    for here, after in zip(rows, [*rows[1:], None]):
        ids = here["ids"]
        if after is None:
            out.append(ids[4 * from_id:])
            break
        heads = dict(zip(after["head_at"], after["head_id"]))
        for x, n in zip(here["tail_at"], here["tail_id"]):
            if x in heads and n >= from_id:
                out.append(ids[4 * from_id:4 * n])
                from_id = heads[x]
                break
        else:
            return None
    return b"".join(out)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), raw (their bytes joined), per row of docs."""
    task, long = encode_chunks(path, pattern, chunk, overlap), F.length(text_or_empty(text_col)) > chunk
    # two scans, so that no text is encoded twice and only chunks of longer texts are shuffled
    whole = (chunk_rows(docs.filter(~long), id_col, text_col, chunk, overlap)
             .mapInArrow(task, ENCODED).select("doc_id", "ids", "raw"))
    pieces = (chunk_rows(docs.filter(long), id_col, text_col, chunk, overlap)
              .mapInArrow(task, ENCODED))
    joined = (pieces.groupBy("uid")
              .applyInArrow(join_chunks(path, pattern, chunk), "doc_id bigint, ids binary, raw binary"))
    return whole.unionByName(joined)


def join_chunks(path: str, pattern: str, chunk: int) -> Callable:
    """The function for applyInArrow: the chunks of one text to its ids and bytes."""

    def run(chunks):
        import pyarrow as pa
        import regex

        rows = sorted(chunks.to_pylist(), key=lambda r: r["chunk"])
        ids = stitch(rows)
        if ids is None:
            text = "".join(r["part"][:chunk] for r in rows[:-1]) + rows[-1]["part"]
            encoder = Encoder(load_ranks(path))
            ids = b"".join(map(encoder.__getitem__, regex.findall(pattern, text)))
        return pa.table({"doc_id": pa.array([rows[0]["doc_id"]], pa.int64()),
                         "ids": pa.array([ids], pa.binary()),
                         "raw": pa.array([decode(ids, token_list(path))], pa.binary())})
    return run


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("raw", 256).alias("decoded_sha256"))
