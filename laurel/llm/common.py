"""Small helpers that the operators share."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laurel.session import ship, stage

__all__ = ["Hashes", "batches_of", "bounded_sample", "free_name", "held_out", "mix64", "ship", "stage", "table", "word_list"]

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with as many underscores before it as keep it off the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def held_out(doc_id, modulus: int, remainder: int):
    """crc32 of the id as text leaves this remainder; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == remainder, F.lit(False))


def bounded_sample(rows: DataFrame, most: int, n: int, *key: str) -> DataFrame:
    """The ``most`` rows of smallest key hash, or nearly as many; the same rows in any order.

    ``n`` is the number of rows.  A hash below a bound lets about twice as many through, so
    that what tasks report for the final choice doesn't grow with the input.
    """
    place = F.xxhash64(*key)
    if n > 2 * most:
        rows = rows.where(F.pmod(place, F.lit(1 << 40)) < int(2 * most / n * (1 << 40)))
    return rows.orderBy(place, *key).limit(most)


def word_list(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased; bytes methods touch ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class Hashes(dict):
    """64-bit hashes of words; forgets all when it has ``limit`` words, so memory is bounded."""

    def __init__(self, limit=200_000):
        self.limit = limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (wrap-around arithmetic)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def batches_of(batch: pa.RecordBatch, texts: str, most_chars=4_000_000):
    """Slices of an Arrow batch that hold about ``most_chars`` of text, one row at least."""
    column = batch.column(texts)
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most_chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)
