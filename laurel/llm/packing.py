"""Best-fit packing after Martello-Toth dominance reduction (operator 2).

Piece lengths are whole numbers up to the sequence size, so an instance of any size is a
histogram of at most ``size`` counts.  The driver solves the histogram: it fixes dominating
sets many at a time, then places what is left by best fit, decreasing.  Both steps speak of
runs of equal pieces and of equal bins, so the plan has a number of records that depends
on ``size`` only.  Spark tokenises, numbers the pieces of each length, and reads each
piece's place off the plan.
"""

import functools
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from laurel.llm.common import stage

SIZE = 4096
END = 1

# The word pattern of the tokenizer file, for lower-case Latin-1.
_LETTER, _NUMBER = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^ \n{_LETTER}{_NUMBER}]+")
PLAIN = re.compile("[ \n!-~\u00a1-\u00ff]*")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, others come from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Recent(dict):
    """Values made once and kept while in use, in bounded memory.

    When ``limit`` keys are held they become the old ones, and the old ones before them go;
    an old key that is asked for again is held anew.
    """

    def __init__(self, make, limit):
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordTokens:
    """Token ids of texts, word by word through a cache of their bytes, which are joined.

    No token spans two words of the tokenizer's pattern.  Printable Latin-1 is split here
    and its words go straight to the tokenizer's merge model; any other text is cut at
    blanks, where no token passes either, and its stretches go through the whole tokenizer
    unless they are plain themselves.
    """

    def __init__(self, path: str, limit=400_000):
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = byte_letters()
        self.numbers = [i.to_bytes(4, "little") for i in range(self.whole.get_vocab_size())]
        self.words = Recent(self._word, limit)

    def _word(self, word):
        spelt = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.numbers[t.id] for t in self.model.tokenize(spelt)])

    def encoded(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        text = text or ""
        if PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.words.__getitem__, WORD.findall(text.lower())))
        parts = []
        for part in text.replace("\n", " ").split(" "):
            if PLAIN.fullmatch(part) and "<|" not in part:
                parts.append(self.encoded(part))
            else:
                ids = self.whole.encode(part, add_special_tokens=False).ids
                parts.append(np.array(ids, "<u4").tobytes())
        return b"".join(parts)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encoded(text), "<u4").tolist()


@functools.lru_cache(1)
def word_tokens(path: str) -> WordTokens:
    """One for each worker, kept from task to task."""
    return WordTokens(path)


def token_pieces(docs: DataFrame, size=SIZE, tokenizer=None, with_ids=False) -> DataFrame:
    """Cut each document's tokens, closed by an end token, into pieces of at most ``size``.

    Returns ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.  A null
    or empty text is one piece that holds the end token.  Only longer documents are cut;
    repeated rows are packed as often as they come, null ids too.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    shape = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def cut(batches):
        words, end = word_tokens(path), END.to_bytes(4, "little")
        for batch in batches:
            out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.encoded(text.as_py()) + end
                for piece, start in enumerate(range(0, len(ids) // 4, size)):
                    part = ids[4 * start : 4 * (start + size)]
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    if with_ids:
                        out["ids"].append(np.frombuffer(part, "<i4"))
            kinds = {"piece": pa.int32(), "ids": pa.list_(pa.int32())}
            names = list(out) if with_ids else list(out)[:-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[n], kinds.get(n, pa.int64())) for n in names], names
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, shape + ", ids array<int>" * with_ids)


class Plan:
    """Places for runs of equal pieces.

    A record ``(length, first, count, bin, each, offset)`` sends the pieces ``first`` to
    ``first + count - 1`` of that length to bins from ``bin`` on, ``each`` a bin, one behind
    the other from ``offset``.
    """

    def __init__(self):
        self.records: list[tuple[int, int, int, int, int, int]] = []
        self.bins = 0
        self.next: dict[int, int] = {}

    def put(self, length, count, first_bin, each, offset):
        first = self.next.get(length, 0)
        self.records.append((length, first, count, first_bin, each, offset))
        self.next[length] = first + count

    def fix(self, lengths, times):
        """``times`` new bins, each with one set of these lengths."""
        offset = 0
        for length in lengths:
            self.put(length, times, self.bins, 1, offset)
            offset += length
        self.bins += times


def fixed_sets(counts: np.ndarray, size: int, plan: Plan) -> np.ndarray:
    """Martello-Toth reduction of a histogram; fixes sets in ``plan``, returns what is left.

    For the longest piece j of each length, with the pieces that could stand beside it:
    alone, if nothing fits beside it; with its largest partner a, if that fills the bin or no
    two pieces fit beside j; with a pair (a, b), if no three fit beside j, a is the largest
    partner, b the largest beside both, and no two pieces heavier than b fit.  Each such set
    holds, for any other feasible set around j, pieces at least as heavy in distinct places,
    so some best packing contains it.
    """
    left = counts.copy()
    changed = True
    while changed:
        changed = False
        for j in range(size, 0, -1):
            while left[j]:
                chosen = dominating(left, j, size)
                if chosen is None:
                    break
                need: dict[int, int] = {}
                for length in chosen:
                    need[length] = need.get(length, 0) + 1
                # all partners are of equal kind, so the set can be taken until one kind ends;
                # a pair that doesn't fill the bin is looked at anew each time
                times = min(int(left[k]) // n for k, n in need.items())
                plan.fix(chosen, times)
                for length, n in need.items():
                    left[length] -= n * times
                changed = True
    return left


def largest(left: np.ndarray, room: int) -> int:
    """The longest remaining length of at most ``room``, else 0."""
    here = np.flatnonzero(left[: max(room, 0) + 1])
    return int(here[-1]) if len(here) else 0


def smallest(left: np.ndarray, n: int, above: int = 0) -> list[int]:
    """The ``n`` shortest remaining pieces longer than ``above``, or all if fewer."""
    found: list[int] = []
    for length in np.flatnonzero(left[above + 1 :])[:n] + above + 1:
        found += [int(length)] * min(int(left[length]), n - len(found))
    return found[:n]


def dominating(left: np.ndarray, j: int, size: int):
    rest = left.copy()
    rest[j] -= 1
    room = size - j
    a = largest(rest, room)
    if a == 0:
        return (j,)
    if a == room:
        return (j, a)
    two = smallest(rest, 2)
    if len(two) < 2 or sum(two) > room:
        return (j, a)
    three = smallest(rest, 3)
    if len(three) == 3 and sum(three) <= room:
        return None
    rest[a] -= 1
    b = largest(rest, room - a)
    if b == 0:
        return None
    rest[a] += 1
    heavier = smallest(rest, 2, above=b)
    if len(heavier) < 2 or sum(heavier) > room:
        return (j, a, b)
    return None


def best_fit(left: np.ndarray, size: int, plan: Plan) -> None:
    """Place the rest by falling length, each piece in the fullest bin that takes it.

    Equal bins stand in runs ``(first bin, how many)`` by the room they have left.  A piece
    goes to the least room that takes it and its like follow there, so a run is served as a
    whole; only the last run that a length reaches is split.
    """
    runs: dict[int, list[tuple[int, int]]] = {}
    for length in range(size, 0, -1):
        n = int(left[length])
        if not n:
            continue
        for room in sorted(r for r in runs if r >= length):
            each = room // length
            waiting = runs.pop(room)
            while waiting and n:
                first, bins = waiting.pop()
                used = min(bins, n // each)
                if used:
                    plan.put(length, used * each, first, each, size - room)
                    runs.setdefault(room - each * length, []).append((first, used))
                    n -= used * each
                    first, bins = first + used, bins - used
                if bins and n:  # fewer than ``each`` pieces are left
                    plan.put(length, n, first, n, size - room)
                    runs.setdefault(room - n * length, []).append((first, 1))
                    n, first, bins = 0, first + 1, bins - 1
                if bins:
                    waiting.append((first, bins))
            if waiting:
                runs.setdefault(room, []).extend(waiting)
            if not n:
                break
        if n:
            each = size // length
            used, over = divmod(n, each)
            if used:
                plan.put(length, used * each, plan.bins, each, 0)
                runs.setdefault(size - each * length, []).append((plan.bins, used))
                plan.bins += used
            if over:
                plan.put(length, over, plan.bins, over, 0)
                runs.setdefault(size - over * length, []).append((plan.bins, 1))
                plan.bins += 1


def solve(counts: np.ndarray, size: int = SIZE) -> Plan:
    """``counts[length]`` pieces of each length, at index 0 none."""
    plan = Plan()
    best_fit(fixed_sets(counts.astype(np.int64), size, plan), size, plan)
    return plan


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have a ``length`` from 1 to ``size``.

    Pieces of equal length are interchangeable for the plan; they are numbered by
    ``(doc_id, piece)``.  The numbers come from a range partitioning and the sizes of its
    parts, so a length that a third of all pieces share is dealt over many tasks.  Ties and
    repeated rows are numbered in any order.
    """
    dealt = stage(
        pieces.repartitionByRange("length", "doc_id", "piece")
        .sortWithinPartitions("length", "doc_id", "piece")
        .withColumn("packed_at", F.monotonically_increasing_id()),
        "pieces",
    )
    # the number is part << 33 | row; ranges ascend with the part
    parts = dealt.groupBy(F.shiftright("packed_at", 33).alias("part"), "length").count()
    by_part = parts.groupBy("part").agg(F.sum("count").alias("n")).orderBy("part").collect()
    part_start = dict(zip((r.part for r in by_part), np.cumsum([0, *(r.n for r in by_part)]).tolist()))
    counts = np.zeros(size + 1, np.int64)
    for row in parts.groupBy("length").agg(F.sum("count").alias("n")).collect():
        counts[row.length] = row.n
    plan = solve(counts, size)
    records = np.array(sorted(plan.records), np.int64).reshape(-1, 6)
    starts = np.concatenate([[0], np.cumsum(counts)])  # the first piece of each length, over all
    # as the pieces are sorted by length, records have places in one line
    line = starts[records[:, 0]] + records[:, 1]
    sent = dealt.sparkSession.sparkContext.broadcast((part_start, line, records))
    names = dealt.columns[:-1]

    def place(frames):
        part_start, line, records = sent.value
        for frame in frames:
            at = frame["packed_at"].to_numpy()
            first = np.array([part_start[p] for p in (at >> 33).tolist()], np.int64)
            number = first + (at & ((1 << 33) - 1))
            row = records[np.searchsorted(line, number, "right") - 1]
            k = number - line[np.searchsorted(line, number, "right") - 1]
            yield frame[names].assign(
                sequence_id=row[:, 3] + k // row[:, 4],
                offset=row[:, 5] + (k % row[:, 4]) * row[:, 0],
            )

    schema = dealt.drop("packed_at").schema.add("sequence_id", "long").add("offset", "long")
    return dealt.mapInPandas(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id, ids, docs`` from pieces that carry ``ids``."""
    inner = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "piece")))
    return packed.groupBy("sequence_id").agg(inner.alias("p")).select(
        "sequence_id",
        F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"),
        F.transform("p", lambda x: F.struct(x["doc_id"], x["piece"], x["offset"])).alias("docs"),
    )


def pack_documents(docs: DataFrame, size: int = SIZE, tokenizer=None, with_ids=False) -> DataFrame:
    """Tokenise, cut and pack; the pieces are staged, so that they are made once."""
    return pack(stage(token_pieces(docs, size, tokenizer, with_ids), "tokens"), size)
