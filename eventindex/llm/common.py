"""What several operators share: words, token hashes, row tags and batch helpers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# fixed values: a word is a run of anything but space and the controls 09 to 0D
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; a null id counts as the empty text."""
    digits = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.pmod(F.crc32(digits.cast("binary")), F.lit(divisor)).cast("int")


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased. Only ASCII bytes are split at or changed, so the
    bytes of other characters stay together."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class HashCache(dict):
    """64-bit hashes of words; emptied when it holds `limit` words, so memory is bounded."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit (the public
    domain finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# odd factors of the places in a run of words
PLACES = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `width` words; a shorter text is one run."""
    n = len(hashes)
    if n == 0:
        return hashes
    width_here = min(width, n)
    # a sum with odd factors, one per place, finalised once
    runs = np.full(n - width_here + 1, width_here, np.uint64)
    for k in range(width_here):
        runs += hashes[k:n - width_here + 1 + k] * PLACES[k]
    runs = mix(runs)
    runs.sort()
    first = np.ones(len(runs), bool)
    np.not_equal(runs[1:], runs[:-1], out=first[1:])
    return runs[first]


def rows_of(batch, *cols: str) -> Iterator[tuple]:
    """Rows of an Arrow batch as Python values, column by column."""
    return zip(*(batch.column(c).to_pylist() for c in cols))
