"""Language identification by rank-order profiles (operator 1).

A profile lists the most frequent letter n-grams of a language, most frequent first.  A
document's own list is compared to each: every n-gram counts by how far its rank is out of
place, one that the profile lacks by the full length.  The nearest language wins.
"""

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROFILE = 300  # n-grams of a profile, of a language or a document
EDGE = 1  # stands for a word's edge; no letter has this code point
BLOCK = 1 << 20
UNKNOWN = "und"


@functools.cache
def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_blocks(text: str | None):
    """Arrays of n-gram codes of one to three letters, edges included, block by block.

    Code points take 21 bits each, so codes are exact.  No n-gram spans two words.
    """
    if not text:
        return
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where(letter_table()[codes], codes, EDGE).astype(np.uint64)
    codes = np.concatenate([[np.uint64(EDGE)], codes, [np.uint64(EDGE)]])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != EDGE) | (codes[:-1] != EDGE)
    codes = codes[keep]
    if len(codes) < 2:
        return
    for i in range(0, len(codes), BLOCK):
        part = codes[i : i + BLOCK + 2]
        one = part[:BLOCK]
        two = ((part[:-1] << np.uint64(21)) | part[1:])[:BLOCK]
        three = ((part[:-2] << np.uint64(42)) | (part[1:-1] << np.uint64(21)) | part[2:])[:BLOCK]
        yield np.concatenate([one[one != EDGE], two, three[part[1:-1][: len(three)] != EDGE]])


def counted(parts):
    """Distinct codes and their counts, of ``(codes, counts or None)``."""
    codes = np.concatenate([c for c, _ in parts])
    if all(n is None for _, n in parts):
        return np.unique(codes, return_counts=True)
    ns = np.concatenate([np.ones(len(c), np.int64) if n is None else n for c, n in parts])
    found, at = np.unique(codes, return_inverse=True)
    return found, np.bincount(at, ns, len(found)).astype(np.int64)


def top_grams(text: str | None, most: int) -> np.ndarray:
    """The document's most frequent n-grams, ties to the smaller code."""
    parts = [np.unique(g, return_counts=True) for g in gram_blocks(text)]
    if not parts:
        return np.empty(0, np.uint64)
    codes, counts = parts[0] if len(parts) == 1 else counted(parts)
    return codes[np.argsort(-counts, kind="stable")[:most]]


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over the rows of ``docs``; rows without text or lang add nothing."""

    def count(batches, most=2_000_000):
        held: dict[str, list] = {}
        size = 0

        def rows(flush):
            nonlocal size
            size = 0
            for lang in list(held):
                codes, counts = counted(held[lang])
                held[lang] = [(codes, counts)]
                size += len(codes)
            if flush or size > most // 2:
                for lang, parts in held.items():
                    codes, counts = parts[0]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(codes)), pa.array(codes.astype(np.int64)), pa.array(counts)],
                        ["lang", "gram", "n"],
                    )
                held.clear()
                size = 0

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                for grams in gram_blocks(text.as_py()):
                    held.setdefault(lang.as_py(), []).append((grams, None))
                    size += len(grams)
                    if size > most:
                        yield from rows(False)
        yield from rows(True)

    read = docs.where("text IS NOT NULL AND lang IS NOT NULL").select(
        F.col("text").cast("string"), F.col("lang").cast("string")
    )
    partial = read.mapInArrow(count, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_profiles(docs: DataFrame, most: int = PROFILE) -> list[tuple[str, list[int]]]:
    """``(lang, its most frequent n-grams in order)`` from all labelled rows, by name.

    Ranked in two steps, so that a language's n-grams meet in one task only after each of
    64 parts has kept its best.
    """
    counts = gram_counts(docs).withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(64)))
    order = [F.desc("n"), F.col("gram")]
    some = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = some.where(F.col("r") <= most).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    )
    found: dict[str, list] = {}
    for row in best.where(F.col("rank") <= most).select("lang", "rank", "gram").collect():
        found.setdefault(row.lang, []).append((row.rank, row.gram))
    return [(lang, [g for _, g in sorted(found[lang])]) for lang in sorted(found)]


class Ranks:
    """The profiles as one table: n-gram by language to rank, -1 where a profile lacks it."""

    def __init__(self, profiles, most):
        self.langs, self.most = [lang for lang, _ in profiles], most
        self.grams = np.unique(np.array([g for _, gs in profiles for g in gs], np.uint64))
        self.ranks = np.full((len(profiles), len(self.grams) + 1), -1, np.int32)
        for i, (_, grams) in enumerate(profiles):
            self.ranks[i, np.searchsorted(self.grams, np.array(grams, np.uint64))] = np.arange(len(grams))

    def nearest(self, text):
        """The nearest language and ``1 - distance / greatest distance``."""
        grams = top_grams(text, self.most)
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, grams)
        at = np.where(self.grams[np.minimum(at, len(self.grams) - 1)] == grams, at, len(self.grams))
        ranks = self.ranks[:, at]
        out = np.where(ranks < 0, self.most, np.abs(ranks - np.arange(len(grams))))
        sums = out.sum(axis=1)
        best = int(sums.argmin())
        return self.langs[best], 1.0 - float(sums[best]) / (len(grams) * self.most)


def language_of(text, profiles, most: int = PROFILE):
    """A column ``struct<lang, score>`` for a text column.

    ``und`` with score 0 for a null text, one without a letter, and any text if nothing was
    learned.  Equal distances go to the smaller name.
    """

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        ranks = _ranks(tuple((lang, tuple(g)) for lang, g in profiles), most)
        return pd.DataFrame([ranks.nearest(t) for t in texts], columns=["lang", "score"])

    return predict(text.cast("string"))


@functools.lru_cache(2)
def _ranks(profiles, most):
    return Ranks(profiles, most)


def identify(docs: DataFrame, profiles) -> DataFrame:
    """``docs`` with a last column ``language`` of ``struct<lang, score>``, once made.

    The name must be free; a caller with such a column renames it first.
    """
    # a generator between keeps later filters from running the model again
    return docs.withColumn("language", F.explode(F.array(language_of(F.col("text"), profiles))))
