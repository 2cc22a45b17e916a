"""Language-model scoring by a hierarchical Pitman-Yor model (operator 6).

A word's context is the word before it; a text's first word follows an end mark.  Each
context seen has a restaurant, and all share one parent, the restaurant of words without
context; a context never seen gives the parent's chances.  Dishes are words; a dish's
customers are seated by the Chinese-restaurant rule, and each of its tables sends one
customer to the parent.  Gibbs sweeps seat each dish anew, given all others, and the
predictive probabilities of the last sweeps are averaged.

Dishes are dealt into buckets, whose number grows with the corpus: by their word if it is
rare, else by their context if that is, else by both.  A task seats a bucket.  A dish of one
customer always has one table: only larger ones are seated by a sweep, the others count in
the sums of their context and word.  Between sweeps only sums travel: those of the common
words, a bounded list, in rows of many and by way of the driver, those of rare contexts from
bucket to bucket; rare words have all their dishes in one.  For the scores the texts are read
again, and their pairs meet the seats in the buckets.  A word is known by a 63-bit hash; the
common ones by their rank, which is short to store, and a row of pairs names each hash once.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laurel.llm.common import batches_of, mix64, stage
from laurel.llm.textscan import Words, byte_kinds
from laurel.session import drop_stages, stages

COMMON = 65_536  # words known by their rank
BUCKET_CHARS = 8_000_000  # of the corpus, for each bucket
BLOCK = 2048  # common words whose sums travel in one row
CONTEXTS = 31  # of ``Dishes``, less one, where no number is given
DISCOUNT, STRENGTH = (0.8, 0.6), (10.0, 20.0)  # of the parent and of the contexts
NOVEL = 0.5  # the base's share for words that were never seen
SWEEPS, BURN_IN = 6, 3
ONE_BY_ONE = 32
END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))  # no word holds a line end
CHUNK_CHARS = 4_000_000


def seat(customers: np.ndarray, appeal: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables of each dish after its customers came in.

    The first takes a new table; later ones do with chance ``appeal`` against customers
    seated less ``discount`` a table.  32 are seated one by one, the others in doubling
    blocks, whose number of new tables is a Poisson draw of the same mean.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    live = np.flatnonzero(customers > 1)
    for j in range(1, ONE_BY_ONE):
        live = live[customers[live] > j]
        if not len(live):
            return tables
        a, t = appeal[live], tables[live]
        tables[live] += rng.random(len(live)) * (a + j - discount * t) < a
    j = ONE_BY_ONE
    live = live[customers[live] > j]
    while len(live):
        end = np.minimum(customers[live], 2 * j)
        a = appeal[live]
        seated = np.maximum(j - discount * tables[live], 0.1)
        new = rng.poisson(a * np.log((a + seated + end - j) / (a + seated)))
        tables[live] += np.minimum(new, end - j)
        j *= 2
        live = live[customers[live] > j]
    return tables


class Totals:
    """Customers and tables of every restaurant."""

    def __init__(self, customers, tables, root_customers, root_tables, words):
        self.customers, self.tables = np.asarray(customers, float), np.asarray(tables, float)
        self.root_customers, self.root_tables, self.words = float(root_customers), float(root_tables), int(words)

    def base(self) -> float:
        """The base's share for each word seen."""
        return (1 - NOVEL) / max(self.words, 1)

    def new_root(self) -> float:
        """What the parent has for a new table of a word seen."""
        return (STRENGTH[0] + DISCOUNT[0] * self.root_tables) * self.base()

    def root(self, customers, tables, base):
        new = STRENGTH[0] + DISCOUNT[0] * self.root_tables
        return (customers - DISCOUNT[0] * tables + new * base) / (STRENGTH[0] + self.root_customers)

    def appeal(self, contexts):
        """What a context has for new tables, before the parent's probability."""
        return STRENGTH[1] + DISCOUNT[1] * self.tables[contexts]

    def known(self, contexts, customers, tables, root):
        return (customers - DISCOUNT[1] * tables + self.appeal(contexts) * root) / (STRENGTH[1] + self.customers[contexts])


class Dishes:
    """The model of a corpus that fits in memory: dishes ``(word, context, customers)`` and their seating."""

    def __init__(self, word: np.ndarray, context: np.ndarray, customers: np.ndarray, n_words: int, n_contexts: int = CONTEXTS + 1):
        self.word, self.context, self.customers = word, context, customers
        self.n_words, self.n_contexts = n_words, n_contexts
        self.tables = np.minimum(customers, 1)
        self.root_customers = np.bincount(word, self.tables, n_words).astype(np.int64)
        self.root_tables = np.minimum(self.root_customers, 1)

    def totals(self) -> Totals:
        return Totals(
            np.bincount(self.context, self.customers, self.n_contexts), np.bincount(self.context, self.tables, self.n_contexts),
            self.root_customers.sum(), self.root_tables.sum(),
            np.count_nonzero(np.bincount(self.word, self.customers, self.n_words)),
        )

    def root(self, totals: Totals) -> np.ndarray:
        return totals.root(self.root_customers, self.root_tables, totals.base())

    def sweep(self, totals: Totals, rng) -> None:
        """Seat all dishes anew, contexts first, then the parent's."""
        root = self.root(totals)[self.word]
        self.tables = seat(self.customers, totals.appeal(self.context) * root, DISCOUNT[1], rng)
        self.root_customers = np.bincount(self.word, self.tables, self.n_words).astype(np.int64)
        new = (STRENGTH[0] + DISCOUNT[0] * totals.root_tables) * totals.base()
        self.root_tables = seat(self.root_customers, np.full(self.n_words, new), DISCOUNT[0], rng)


class Lexicon:
    """The common words, most frequent first, as sorted hashes with their ranks."""

    BITS = 18  # by these first bits of a hash its neighbours are found

    def __init__(self, hashes: list[int]):
        found = np.array(hashes, np.uint64)
        self.order = np.argsort(found)
        self.sorted, self.size = found[self.order], len(found)
        self.begins = np.searchsorted(self._first_bits(self.sorted), np.arange((1 << self.BITS) + 1))

    def _first_bits(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.BITS)).view(np.int64)

    def ranks(self, h: np.ndarray) -> np.ndarray:
        """The rank of each word, -1 if it isn't common."""
        out, first = np.full(len(h), -1), self._first_bits(h)
        at, end = self.begins[first], self.begins[first + 1]
        left = np.flatnonzero(at < end)
        at, end, h = at[left], end[left], h[left]
        while len(left):
            hit = self.sorted[at] == h
            out[left[hit]] = self.order[at[hit]]
            more = ~hit & (at + 1 < end)
            left, at, end, h = left[more], at[more] + 1, end[more], h[more]
        return out


#: What a row says, in the tables that go from sweep to sweep.
STATE, NEAR, CONTEXT, WORD, ALL, PIECE, INFO = range(7)
KEPT = SWEEPS - BURN_IN
_HIST = [f"h{j}" for j in range(KEPT)]
_NUMBERS = ["kind", "bucket", "code", "a", "b", *_HIST]
SHAPE = "kind int, bucket int, code long, a long, b long, " + "".join(f"{h} long, " for h in _HIST) + "arrays binary"
_GAPS = byte_kinds(b" \t\n\x0b\x0c\r")
_ZSTD = pa.Codec("zstd", compression_level=1)


def _zipped(arrays: list[np.ndarray]) -> bytes:
    """Arrays as bytes: the length of what was compressed, then their number, sizes and contents."""
    raw = [v if v.dtype == np.int32 else np.asarray(v, np.int64) for v in arrays]
    data = b"".join([np.array([len(raw), *(v.nbytes for v in raw)]).tobytes(), *(v.tobytes() for v in raw)])
    return len(data).to_bytes(8, "little") + _ZSTD.compress(data, asbytes=True)


def _unzipped(cell: pa.BinaryScalar) -> list[memoryview]:
    buffer = cell.as_buffer()
    data = memoryview(_ZSTD.decompress(buffer[8:], int.from_bytes(buffer[:8].to_pybytes(), "little")))
    n = int(np.frombuffer(data, np.int64, 1)[0])
    ends = np.cumsum([8 + 8 * n, *np.frombuffer(data, np.int64, n, 8)]).tolist()
    return [data[i:j] for i, j in zip(ends, ends[1:])]


def rows_of(kind, bucket, code=0, a=0, b=0, hist=(), arrays=None) -> pa.RecordBatch:
    """Rows of ``SHAPE``: one for each code, or one for each list of arrays."""
    n = len(arrays) if arrays is not None else np.size(code)
    numbers = dict.fromkeys(_NUMBERS, 0) | {"kind": kind, "bucket": bucket, "code": code, "a": a, "b": b} | dict(zip(_HIST, hist))
    kinds = {"kind": pa.int32(), "bucket": pa.int32()}
    columns = [pa.array(np.broadcast_to(np.asarray(v, np.int64), n), pa.int64()).cast(kinds.get(c, pa.int64())) for c, v in numbers.items()]
    held = pa.nulls(n, pa.binary()) if arrays is None else pa.array([_zipped(row) for row in arrays], pa.binary())
    return pa.RecordBatch.from_arrays([*columns, held], [*_NUMBERS, "arrays"])


def arrays_of(batch: pa.RecordBatch) -> list[list[np.ndarray]]:
    """The arrays of each row, which travel as bytes."""
    return [[np.frombuffer(v, np.int64) for v in _unzipped(cell)] for cell in batch.column("arrays")]


def packed(context: np.ndarray, word: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """Pairs in half the bytes: a list of the rare words, which are known by their places there, and the columns."""
    rare = np.unique(np.concatenate([context[context < 0], word[word < 0]]))
    short = (np.where(c < 0, -1 - np.searchsorted(rare, c), c) for c in (context, word))
    return [rare, *(c.astype(np.int32) for c in (*short, *counts))]


def unpacked(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The pairs of all rows as they were: ``context, word`` and the other columns, and the number of pairs of each row."""
    out = []
    for cell in batch.column("arrays"):
        rare, *columns = _unzipped(cell)
        context, word, *counts = (np.frombuffer(c, np.int32) for c in columns)
        rare = np.append(np.frombuffer(rare, np.int64), 0)  # where a code isn't rare, its place isn't used
        out.append([*(np.where(c < 0, rare[np.maximum(-1 - c, 0)], c) for c in (context, word)), *counts])
    return [*(np.concatenate(c) for c in zip(*out)), np.array([len(row[0]) for row in out])]


def blocks_of(kind: int, bucket: int, code: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
    """Sums of ``values`` for each common word, a row for each block of words that has any."""
    common = code >= 0
    code = code[common]
    n = int(code.max(initial=-1)) // BLOCK + 1
    sums = np.array([np.bincount(code, v[common], n * BLOCK) for v in values]).astype(np.int64)
    sums = sums.reshape(len(values), n, BLOCK).swapaxes(0, 1)
    some = np.flatnonzero(sums.any(axis=(1, 2)))
    return rows_of(kind, bucket, some, arrays=[[sums[i]] for i in some])


def block_sums(batches):
    """One row for each block that the task got, with the sums of all buckets."""
    held: dict[tuple, np.ndarray] = {}
    for batch in batches:
        for key, cell in zip(zip(batch.column("kind").to_pylist(), batch.column("code").to_pylist()), batch.column("arrays")):
            block = np.frombuffer(_unzipped(cell)[0], np.int64)
            if key in held:
                held[key] += block
            else:
                held[key] = block.copy()
    for (kind, code), block in held.items():
        yield rows_of(kind, 0, code, arrays=[[block]])


def one_bucket(batches):
    """Everything a task got on its bucket: ``bucket, {kind: rows}``, or nothing."""
    table = [b for b in batches if b.num_rows]
    if not table:
        return None, {}
    table = pa.Table.from_batches(table)
    kinds = np.asarray(table["kind"])
    # a task has one bucket
    return table["bucket"][0].as_py(), {k: table.filter(pa.array(kinds == k)).combine_chunks() for k in np.unique(kinds).tolist()}


def near_of(found: dict) -> list[np.ndarray]:
    """What a bucket heard of its rare contexts, in the order of their codes: code, a, b and the kept sweeps'."""
    if NEAR not in found:
        return [np.empty(0, np.int64)] * (3 + KEPT)
    heard = pa.concat_arrays([c.flatten() for c in found[NEAR]["near"].chunks])
    columns = [np.asarray(heard.field(i)) for i in range(3 + KEPT)]
    order = np.argsort(columns[0])
    return [c[order] for c in columns]


def pairs_of(texts: pa.Array, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The context of each token, which is the token before it, the token, and the place of its text.

    Common words are known by their ranks, others by negative hashes.
    """
    words = Words(texts, _GAPS)
    h = words.hashes(0)
    ranks = lexicon.ranks(h)
    code = np.where(ranks >= 0, ranks, (h | np.uint64(1 << 63)).view(np.int64))
    ends = np.searchsorted(words.doc, np.arange(1, len(texts) + 1))
    word = np.insert(code, ends, 0)  # the end mark is the first common word
    return np.append(0, word[:-1]), word, np.insert(words.doc, ends, np.arange(len(texts)))


def buckets_of(context: np.ndarray, word: np.ndarray, most: int) -> np.ndarray:
    """A dish lies with its word if that is rare, else with its context if that is rare."""
    both = context * COMMON + word
    key = np.where(word < 0, word, np.where(context < 0, context, both))
    return (mix64(mix64(key.view(np.uint64)) + np.uint64(1)) % np.uint64(most)).astype(np.int64)


def common_words(docs: DataFrame, most: int = COMMON) -> list[int]:
    """Hashes of the end mark and the words most frequent in ``docs``, most frequent first.

    Each task reports its ``most`` best, and a word needs a 32nd of an equal share of what was
    reported; one at the edge may be missed, which changes how it is stored, not its count.
    """

    def best(batches):
        held, size = [], 0

        def merged():
            words = np.concatenate([w for w, _ in held] or [np.empty(0, np.uint64)])
            ns = np.concatenate([n for _, n in held] or [np.empty(0, np.int64)])
            found, at = np.unique(words, return_inverse=True)
            return found, np.bincount(at, ns, len(found)).astype(np.int64)

        for whole in batches:
            for batch in batches_of(whole, "text"):
                held.append(np.unique(Words(batch.column("text"), _GAPS).hashes(0), return_counts=True))
                size += len(held[-1][0])
                if size > 2_000_000:
                    held[:] = [merged()]
                    if len(held[0][0]) > 1_000_000:  # the rarest can't matter much here
                        keep = np.argsort(-held[0][1], kind="stable")[:500_000]
                        held[:] = [(held[0][0][keep], held[0][1][keep])]
                    size = len(held[0][0])
        words, ns = merged()
        keep = np.argsort(-ns, kind="stable")[:most]
        yield pa.RecordBatch.from_arrays([pa.array(words[keep].view(np.int64)), pa.array(ns[keep])], ["word", "n"])

    rows = docs.where("text IS NOT NULL").select(F.col("text").cast("string").alias("text"))
    counts = stage(rows.mapInArrow(best, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "frequent")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # at most 32 x ``most`` words have so large a share, so no more reach the driver
    top = counts.where(F.col("n") * (32 * most) >= total)
    top = top.orderBy(F.desc("n"), "word").limit(most - 1).collect()
    return [int(END), *(r.word % 2**64 for r in top)]


def _summed(n: np.ndarray, *keys: np.ndarray) -> list[np.ndarray]:
    """The distinct rows of ``keys``, the last one first in order, and the sum of ``n`` of each."""
    order = np.lexsort(keys)
    keys = [k[order] for k in keys]
    new = np.flatnonzero(np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0)))
    return [*(k[new] for k in keys), np.add.reduceat(n[order], new, dtype=np.int64)]


def _dealt(most: int, context: np.ndarray, word: np.ndarray, doc: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """``bucket, context, word, doc, n`` with equal rows summed, by bucket and document.

    Rows are put in order by one hash.  Should two pairs share it, one may come in several rows.
    """
    bucket = buckets_of(context, word, most)
    bits = np.uint64(int(most).bit_length())
    pair = mix64(mix64(context.view(np.uint64)) + word.view(np.uint64))
    low = (doc.astype(np.uint64) << np.uint64(48)) | (pair >> np.uint64(16))
    order = np.argsort((bucket.astype(np.uint64) << (np.uint64(64) - bits)) | (low >> bits))
    keys = [k[order] for k in (bucket, context, word, doc)]
    new = np.flatnonzero(np.append(True, np.any([k[1:] != k[:-1] for k in keys[1:]], axis=0)))
    return [*(k[new] for k in keys), np.add.reduceat(n[order], new, dtype=np.int64)]


def _by_code(code: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """The distinct codes, and the sums of ``values`` of each."""
    found, at = np.unique(code, return_inverse=True)
    return [found, *(np.bincount(at, v, len(found)).astype(np.int64) for v in values)]


def pieces_of(docs: DataFrame, sent, most: int, with_docs=False) -> DataFrame:
    """Pairs of each batch, a row for each bucket: ``context, word, n`` with the counts in training texts.

    With documents, a pair has a count for each document, less than zero if that is held out,
    and each batch has a row that names its documents, with what common words give to the base.
    ``docs`` has ``row, doc_id, text, held``; ``sent`` the common words and, with documents,
    their counts.
    """

    def read(batches):
        hashes, counts = sent.value
        lexicon = Lexicon(hashes)
        for whole in batches:
            for batch in batches_of(whole, "text", CHUNK_CHARS):
                context, word, doc = pairs_of(batch.column("text"), lexicon)
                held, first = np.asarray(batch.column("held").to_pylist(), bool), batch.column("row")[0].as_py()
                if with_docs:
                    ids, size = batch.column("doc_id"), batch.num_rows
                    at, seen = doc[word >= 0], counts[word[word >= 0]]
                    base = np.bincount(at, np.log10(seen + 0.5), size).view(np.int64)
                    known = np.asarray(ids.is_valid().to_pylist(), bool)
                    says = [np.asarray(ids.fill_null(0)), known, held, np.bincount(doc, minlength=size), base, np.bincount(at, seen > 0, size)]
                    yield rows_of(INFO, int(mix64(np.array([first], np.uint64))[0] % np.uint64(most)), first, arrays=[says])
                    n = np.where(held[doc], -1, 1)
                else:
                    doc, n = np.zeros_like(doc), (~held[doc]).astype(np.int64)
                bucket, context, word, doc, n = _dealt(most, context, word, doc, n)
                found, begins = np.unique(bucket, return_index=True)
                ends = [*begins[1:], len(bucket)]
                # documents by the steps from one to the next, which are small
                columns = [context, word, n, np.diff(doc, prepend=0)] if with_docs else [context, word, n]
                for i in begins[1:] if with_docs else ():
                    columns[3][i] = doc[i]
                yield rows_of(PIECE, found, np.full(len(found), first), arrays=[packed(*(c[i:j] for c in columns)) for i, j in zip(begins, ends)])

    return docs.mapInArrow(read, SHAPE)


def first_seats(batches):
    """The dishes of a bucket, those of one customer as sums only."""
    bucket, found = one_bucket(batches)
    if bucket is None:
        return
    context, word, n, _ = unpacked(found[PIECE])
    word, context, n = _summed(n, word, context)
    alone, more = (n == 1).astype(np.int64), (n > 1).astype(np.int64)
    rare = word < 0
    code, count, one, many = _by_code(word[rare], n[rare], alone[rare], more[rare])
    near, near_all, near_alone, near_many = _by_code(context[context < 0], *(v[context < 0] for v in (n, alone, more)))
    m = n > 1
    none = np.empty(0, np.int64)
    yield rows_of(STATE, bucket, arrays=[[context[m], word[m], n[m], n[m] * 0, code, count, one, one + many, np.minimum(one + many, 1), none, none]])
    yield rows_of(NEAR, bucket, near, near_all, near_alone, [near_many])
    for kind, c in ((CONTEXT, context), (WORD, word)):
        yield blocks_of(kind, bucket, c, n, alone, more)
    yield rows_of(ALL, bucket, 0, np.sum(one + many), np.count_nonzero(one + many), [count.sum()])
    yield rows_of(ALL, bucket, 1, np.count_nonzero(count))


def rare_at(codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return np.minimum(np.searchsorted(codes, wanted), max(len(codes) - 1, 0))


def values_of(code: np.ndarray, common: np.ndarray, rare_codes: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """The value of each code: from a list by rank, or beside the sorted codes of the rare ones."""
    if not len(rare_codes):
        return common[code]
    return np.where(code >= 0, common[np.maximum(code, 0)], rare[rare_at(rare_codes, code)])


def sweep_of(sent, seed: int, keep: bool):
    """Seats the dishes of a bucket, then its rare words at the parent."""

    def run(batches):
        bucket, found = one_bucket(batches)
        if STATE not in found:
            return
        totals, tables_common, root_common = sent.value
        context, word, n, seats, code, count, one, customers, tables, *hist = arrays_of(found[STATE])[0]
        near, near_alone, near_all, *past = near_of(found)
        rng = np.random.default_rng([seed, bucket])
        root = totals.root(customers, tables, np.where(count > 0, totals.base(), NOVEL))
        appeal = (STRENGTH[1] + DISCOUNT[1] * values_of(context, tables_common, near, near_all)) * values_of(word, root_common, code, root)
        now = seat(n, appeal, DISCOUNT[1], rng)
        rare = word < 0
        customers = one + np.bincount(np.searchsorted(code, word[rare]), now[rare], len(code)).astype(np.int64)
        tables = seat(customers, np.full(len(code), totals.new_root()), DISCOUNT[0], rng)
        at = context < 0
        here = np.bincount(np.searchsorted(near, context[at]), now[at], len(near)).astype(np.int64)
        if keep:
            seats, hist = seats + now, [np.append(h, v) for h, v in zip(hist, (customers, tables))]
            past = [*past[1:], here]
        yield rows_of(STATE, bucket, arrays=[[context, word, n, seats, code, count, one, customers, tables, *hist]])
        yield rows_of(NEAR, bucket, near, near_alone, here, past)
        for kind, c in ((CONTEXT, context), (WORD, word)):
            yield blocks_of(kind, bucket, c, now)
        yield rows_of(ALL, bucket, 0, customers.sum(), tables.sum())

    return run


def scores_of(sent):
    """Sums over the pairs of a bucket for each document, and the names of documents."""

    def run(batches):
        bucket, found = one_bucket(batches)
        if bucket is None:
            return
        if INFO in found:
            firsts = np.asarray(found[INFO]["code"])
            for first, (ids, valid, held, n, base, known) in zip(firsts.tolist(), arrays_of(found[INFO])):
                yield _partial(first, rare=np.arange(len(ids)), base=base.view(float), known=known, ids=pa.array(ids, mask=valid == 0), held=pa.array(held == 1), n_tokens=n)
        if PIECE not in found:
            return
        kept, all_common = sent.value
        context, word, n, step, sizes = unpacked(found[PIECE])
        firsts = np.asarray(found.pop(PIECE)["code"]).tolist()
        part, doc = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(step, dtype=np.int64)
        begins = np.cumsum(sizes) - sizes
        doc -= np.repeat(doc[begins] - step[begins], sizes)  # the steps of each part begin at its first
        # texts of different parts may have the same place
        groups, at = _numbered(part << 32 | doc)
        del part, doc, step
        order = np.lexsort((word, context))
        context, word, n, at = (v[order] for v in (context, word, n, at))
        del order
        new = np.append(True, (context[1:] != context[:-1]) | (word[1:] != word[:-1]))
        pair, first = np.cumsum(new) - 1, np.flatnonzero(new)
        customers, context, word = np.add.reduceat(np.maximum(n, 0), first, dtype=np.int64), context[first], word[first]
        n = np.abs(n)
        _, _, _, tables, code, count, _, _, _, *hist = arrays_of(found[STATE])[0]
        near, near_all, near_alone, *past = near_of(found)
        seats = customers.astype(float)
        seats[customers > 1] = tables / KEPT
        parent = 0
        for j, (totals, tables_common, root_common) in enumerate(kept):
            sat, held = (h[j * len(code) : (j + 1) * len(code)] for h in hist)
            root = totals.root(sat, held, np.where(count > 0, totals.base(), NOVEL))
            around = values_of(context, tables_common, near, near_alone + past[j])
            parent = parent + (STRENGTH[1] + DISCOUNT[1] * around) * values_of(word, root_common, code, root) / KEPT
        chance = (customers - DISCOUNT[1] * seats + parent) / (STRENGTH[1] + values_of(context, all_common, near, near_all))
        score = np.bincount(at, n * np.log10(chance)[pair], len(groups))
        # the others' base came with the names
        rare = word[pair] < 0
        at, n, seen = at[rare], n[rare], count[rare_at(code, word[pair[rare]])]
        has = np.bincount(at, minlength=len(groups)) > 0
        base, known = (np.bincount(at, n * v, len(groups)) for v in (np.log10(seen + 0.5), seen > 0))
        ends = np.searchsorted(groups, np.arange(len(firsts) + 1) << 32)
        for first, i, j in zip(firsts, ends, ends[1:]):
            of, some = groups[i:j] & 0xFFFFFFFF, has[i:j]
            yield _partial(first, doc=of, score=score[i:j], rare=of[some], base=base[i:j][some], known=known[i:j][some])

    return run


def _numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of ``key``, which mostly comes in order, and the place of each among them."""
    order = np.argsort(key, kind="stable")
    inorder = key[order]
    new = np.append(True, inorder[1:] != inorder[:-1])
    at = np.empty(len(key), np.int64)
    at[order] = np.cumsum(new) - 1
    return inorder[new], at


#: What a bucket, or the row of names, says of the documents of a batch.
LISTS = {"doc": pa.int32(), "score": pa.float64(), "rare": pa.int32(), "base": pa.float64(), "known": pa.int32(), "ids": pa.int64(), "held": pa.bool_(), "n_tokens": pa.int32()}
PARTS = "first long, doc array<int>, score array<double>, rare array<int>, base array<double>, known array<int>, ids array<long>, held array<boolean>, n_tokens array<int>"


def _partial(first, **given) -> pa.RecordBatch:
    columns = []
    for name, kind in LISTS.items():
        v = given.get(name, ())
        v = v.cast(kind) if isinstance(v, pa.Array) else pa.array(np.asarray(v, kind.to_pandas_dtype()), kind)
        columns.append(pa.ListArray.from_arrays(np.array([0, len(v)], np.int32), v))
    return pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), *columns], ["first", *LISTS])


def batch_sums(batches):
    """One row for each batch of documents that the task got: sums for each, and names."""
    held: dict[int, list] = {}
    for batch in batches:
        columns = [batch.column(c) for c in LISTS]
        for i, first in enumerate(batch.column("first").to_pylist()):
            doc, score, rare, base, known = (np.asarray(c[i].values) for c in columns[:5])
            size = 1 + max(int(doc.max(initial=-1)), int(rare.max(initial=-1)))
            mine = held.setdefault(first, [np.zeros((3, size)), {}])
            if mine[0].shape[1] < size:
                mine[0] = np.pad(mine[0], ((0, 0), (0, size - mine[0].shape[1])))
            if len(columns[5][i].values):
                mine[1] = {c: v[i].values for c, v in zip(("ids", "held", "n_tokens"), columns[5:])}
            mine[0][0, doc] += score
            mine[0][1, rare] += base
            mine[0][2, rare] += known
    for first, ((score, base, known), names) in held.items():
        yield _partial(first, doc=np.arange(len(score)), score=score, base=base, known=known, **names)


def score_documents(docs: DataFrame, held: Column, seed: int = 1) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Learns from rows that ``held`` doesn't hold out.  Defined cases: a null text is empty
    and has one token, the end; a null id is never held out; rows that repeat id and text
    count, and are scored, as often as they come; without training rows every word is
    novel.  Other columns play no part.  ``docs`` is read several times and must give the
    same rows in the same order each time, as tables do.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), held.alias("held"),
    )
    first = stages()
    send = spark.sparkContext.broadcast
    lexicon = common_words(rows)
    words = send((lexicon, None))
    size = len(lexicon)
    chars = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    most = 2 * (1 + chars // (2 * BUCKET_CHARS))

    def task(rows, run, shape=SHAPE):
        return rows.repartitionById(most, F.col("bucket")).mapInArrow(run, shape)

    def common_sums(table):
        """The sums of common contexts, and those of common words, a row for each value."""
        blocks = table.where(F.col("kind").isin(CONTEXT, WORD)).repartition("kind", "code").mapInArrow(block_sums, SHAPE)
        blocks = blocks.select("kind", "code", "arrays").toArrow()
        found = {(kind, code): row[0].reshape(-1, BLOCK) for kind, code, row in zip(*(blocks[c].to_pylist() for c in ("kind", "code")), arrays_of(blocks))}
        out = np.zeros((2, max((len(v) for v in found.values()), default=3), -(-size // BLOCK) * BLOCK), np.int64)
        for (kind, code), sums in found.items():
            out[int(kind == WORD), :, code * BLOCK : (code + 1) * BLOCK] = sums
        return out[:, :, :size]

    made = stage(task(pieces_of(rows, words, most), first_seats), "dishes")
    drop_stages(spark, first, stages() - 1)
    (all_common, context_alone, context_many), (count_common, word_alone, word_many) = common_sums(made)
    sums = {r.code: r for r in made.where(F.col("kind") == ALL).groupBy("code").agg(*(F.sum(c).alias(c) for c in ("a", "b", "h0"))).collect()}
    rare_customers, rare_tables, rare_count = (sums[0].a, sums[0].b, sums[0].h0) if sums else (0, 0, 0)
    n_words = int(np.count_nonzero(count_common)) + (sums[1].a if sums else 0)
    train_tokens = int(count_common.sum()) + rare_count
    # every bucket hears of all customers of its rare contexts
    around = Window.partitionBy("code")
    heard = made.where(F.col("kind") == NEAR).select(
        "bucket", "code", *(F.sum(c).over(around).alias(c) for c in ("a", "b")), "h0", F.sum("h0").over(around).alias("many")
    )
    contexts = stage(heard, "contexts")
    near = contexts.where("h0 > 0").select("bucket", "code", F.col("b").alias("a"), (F.col("b") + F.col("many")).alias("b"), *(F.lit(0).cast("long").alias(h) for h in _HIST))
    customers, tables_common = word_alone + word_many, context_alone + context_many
    tables = np.minimum(customers, 1)
    rng = np.random.default_rng(seed)

    def parent():
        totals = Totals((), (), customers.sum() + rare_customers, tables.sum() + rare_tables, n_words)
        return totals, tables_common, totals.root(customers, tables, np.where(count_common > 0, totals.base(), NOVEL))

    def told(others, near):
        """With these rows, one for each bucket of what it hears, as rows are costly to hand to a task."""
        values = F.collect_list(F.struct("code", "a", "b", *_HIST)).alias("near")
        heard = near.groupBy("bucket").agg(values).withColumn("kind", F.lit(NEAR))
        return others.unionByName(heard, allowMissingColumns=True)

    kept, now, state = [], parent(), made.where(F.col("kind") == STATE)
    begun = stages() - 2
    for i in range(SWEEPS):
        keep = i >= BURN_IN
        made = stage(task(told(state, near), sweep_of(send(now), seed * SWEEPS + i, keep)), "swept")
        drop_stages(spark, begun if i == 0 else stages() - 2, stages() - (2 if i == 0 else 1))
        state = made.where(F.col("kind") == STATE)
        near = made.where(F.col("kind") == NEAR).select("bucket", "code", "a", (F.col("a") + F.sum("b").over(around)).alias("b"), *_HIST)
        of_contexts, of_words = common_sums(made)[:, 0]
        tables_common, customers = context_alone + of_contexts, word_alone + of_words
        tables = seat(customers, np.full(size, now[0].new_root()), DISCOUNT[0], rng)
        sums = made.where(F.col("kind") == ALL).agg(F.sum("a"), F.sum("b")).first()
        rare_customers, rare_tables = sums[0] or 0, sums[1] or 0
        now = parent()
        if keep:
            kept.append(now)
    here = made.where(F.col("kind") == NEAR).select(F.lit(-1).alias("bucket"), "code", F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"), *_HIST)
    near = contexts.select("bucket", "code", "a", "b", *(F.lit(0).cast("long").alias(h) for h in _HIST)).union(here)
    near = stage(near.select("bucket", "code", "a", "b", *(F.sum(h).over(around).alias(h) for h in _HIST)).where("bucket >= 0"), "near")
    drop_stages(spark, begun, begun + 1)  # of ``contexts``
    some = pieces_of(rows, send((lexicon, count_common)), most, True).union(state)
    found = task(told(some, near), scores_of(send((kept, all_common))), PARTS)
    whole = stage(found.repartition("first").mapInArrow(batch_sums, PARTS), "scores")
    drop_stages(spark, first, stages() - 1)
    each = float(np.log10(train_tokens + 0.5 * (n_words + 1)))
    lists = [F.col(c) for c in ("ids", "held", "score", "base", "known", "n_tokens")]
    one = whole.select(F.explode(F.arrays_zip(*lists)).alias("d")).select("d.*")
    return one.select(
        F.col("ids").alias("doc_id"), F.col("held").alias("held_out"), F.col("n_tokens").cast("long").alias("n_tokens"),
        F.col("known").cast("long").alias("n_known"), F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * each).alias("base_score"), "score",
    )


def _common_chances(dishes: Dishes, totals: Totals) -> np.ndarray:
    """Predictive probabilities of all words in all contexts, context by word."""
    contexts = np.arange(dishes.n_contexts)
    root = dishes.root(totals)
    out = totals.appeal(contexts)[:, None] * root[None, :]
    np.add.at(out, (dishes.context, dishes.word), dishes.customers - DISCOUNT[1] * dishes.tables)
    return out / (STRENGTH[1] + totals.customers)[:, None]
