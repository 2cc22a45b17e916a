"""Near-duplicate groups by a multi-index Hamming join of MinHash signatures (operator 8).

A signature has 56 symbols of 16 bits, each the low bits of one MinHash of the set of word
shingles.  It is split into 14 chunks of four.  Two signatures that differ in at most 27
symbols have, by pigeonhole, a chunk in which they differ in at most one.  So each signature
is filed under every chunk with each one symbol left out (the allowed error): 56 keys, and
every such pair meets under a key.  A pair of similarity 0.75 differs in 14 symbols on
average; that none of its chunks qualifies has a chance of 7.1e-9.  Pairs that meet are
confirmed up to 36 differing symbols, which leaves out another 1.1e-10: together below 1e-8.

Documents with equal sets form a class and enter once.  Links are confirmed on full sets.
To find groups without listing all pairs of a large one, each class is first linked to one
near leader, then to its nearest neighbour in another group; after that only pairs that cross
the groups found so far are listed, all of them, each once.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel.llm.common import Hashes, batches_of, free_name, mix64, stage, word_list
from laurel.llm.graph import components, grouped

WORDS = 5
CHUNKS, CHUNK = 14, 4
SYMBOLS = CHUNKS * CHUNK
MOST_APART = 2 * CHUNKS - 1  # every such pair shares a key
LOOSE = 36  # pairs that share a key are confirmed on full sets up to this distance
BLOCK = 2048  # rows of one key that are compared at once
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix64(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


def shingles(text: str | None, hashes: Hashes, words: int = WORDS) -> np.ndarray:
    """The sorted set of 64-bit hashes of the text's word shingles; empty without words."""
    found = word_list(text)
    if not found:
        return np.empty(0, np.uint64)
    h = hashes.of(found)
    span = min(words, len(h))
    rolled = np.full(len(h) - span + 1, span, np.uint64)
    for i in range(span):
        rolled = mix64(rolled + h[i : len(h) - span + 1 + i] * _STEP)
    return np.unique(rolled)


def signature(found: np.ndarray) -> np.ndarray:
    """16-bit symbols of the MinHashes; long sets are taken in blocks."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), 8192):
        part = found[i : i + 8192]
        seen = part[None, :] * _SEEDS[:, None]
        seen ^= seen >> np.uint64(29)
        seen *= _STEP
        np.minimum(least, seen.min(axis=1), out=least)
    return (mix64(least) & np.uint64(0xFFFF)).astype("<u2")


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_key, sig``; set_key is null where the set is empty."""

    def sign(batches):
        hashes = Hashes()
        for whole in batches:
            for batch in batches_of(whole, "text"):
                ns, keys, sigs = [], [], []
                for text in batch.column("text"):
                    found = shingles(text.as_py(), hashes)
                    ns.append(len(found))
                    keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                    sigs.append(signature(found).tobytes() if len(found) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(ns, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                    ["doc_id", "n_shingles", "set_key", "sig"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(sign, "doc_id long, n_shingles long, set_key binary, sig binary")


def chunk_keys(classes: DataFrame) -> DataFrame:
    """``key, node``: each class under every chunk with each one symbol left out."""
    kept = [[i for i in range(CHUNK) if i != out] for out in range(CHUNK)]

    def file(batches):
        for batch in batches:
            nodes = np.asarray(batch.column("node"))
            if not len(nodes):
                continue
            sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u2")
            sigs = sigs.reshape(len(nodes), CHUNKS, CHUNK).astype(np.int64)
            keys = np.empty((len(nodes), CHUNKS, CHUNK), np.int64)
            for out in range(CHUNK):
                x, y, z = (sigs[:, :, i] for i in kept[out])
                keys[:, :, out] = (x << 32 | y << 16 | z) << 6
            keys |= np.arange(SYMBOLS).reshape(1, CHUNKS, CHUNK)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(nodes, SYMBOLS))], ["key", "node"]
            )

    return classes.select("node", "sig").mapInArrow(file, "key long, node long")


def apart(sigs_a: np.ndarray, sigs_b: np.ndarray) -> np.ndarray:
    """Differing symbols of all pairs of two signature tables."""
    if len(sigs_a) * len(sigs_b) <= 1024:
        return (sigs_a[:, None, :] != sigs_b[None, :, :]).sum(axis=2)
    out = np.zeros((len(sigs_a), len(sigs_b)), np.uint8)
    for i in range(SYMBOLS):
        out += sigs_a[:, i, None] != sigs_b[None, :, i]
    return out


def nearest_leader(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of ``node, leader`` the nearest leader of each node within the loose distance."""
    one = classes.select("node", "sig")
    other = classes.select(F.col("node").alias("leader"), F.col("sig").alias("leader_sig"))

    def measure(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, SYMBOLS) for c in ("sig", "leader_sig"))
            d = (a != b).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("leader"), pa.array(d.astype(np.int32))], ["node", "leader", "d"]
            ).filter(pa.array(d <= LOOSE))

    near = pairs.join(one, "node").join(other, "leader").select("node", "leader", "sig", "leader_sig")
    near = near.mapInArrow(measure, "node long, leader long, d int")
    best = near.groupBy("node").agg(F.min(F.struct("d", "leader")).alias("m"))
    return best.select(F.col("m.leader").alias("a"), F.col("node").alias("b"))


def _mixed_rows(filed: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of the keys with several groups, with signatures, dealt for comparison.

    Rows of a large key are dealt into blocks, and blocks are compared two by two, so that no
    task holds more than two blocks of a key.
    """
    named = filed.join(labels, "node", "left").select("key", "node", F.coalesce("root", "node").alias("label"))
    named = stage(named, "labelled")
    mixed = named.groupBy("key").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n")
    ).where("lo < hi").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = named.join(mixed, "key").join(classes.select("node", "sig"), "node")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = F.sequence(F.lit(0), F.col("blocks") - 1)
    rows = rows.withColumn("mine", mine).select("key", "node", "label", "sig", "mine", F.explode(met).alias("met"))
    rows = rows.select(
        "key", F.least("mine", "met").alias("p"), F.greatest("mine", "met").alias("q"), "mine", "node", "label", "sig"
    )
    return rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")


class _Rows:
    """The columns of dealt rows, and where a new key or pair of blocks begins."""

    def __init__(self, table: pa.Table, bounds: list[int]):
        self.table, self.bounds = table, bounds
        self.nodes, self.labels, self.mine, self.p, self.q, self.keys = (
            np.asarray(table.column(c)) for c in ("node", "label", "mine", "p", "q", "key")
        )
        self.sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u2").reshape(-1, SYMBOLS)

    def runs(self):
        return zip(self.bounds, self.bounds[1:])

    def compared(self, start: int, end: int):
        """Parts of one run: rows of either side, their distances, and which are close.

        Close pairs lie within the loose distance and in different groups.
        """
        left = start + np.flatnonzero(self.mine[start:end] == self.p[start])
        two_blocks = self.p[start] != self.q[start]
        right = start + np.flatnonzero(self.mine[start:end] == self.q[start]) if two_blocks else left
        for i in range(0, len(left), 256):
            some = left[i : i + 256]
            d = apart(self.sigs[some], self.sigs[right])
            close = (self.labels[some][:, None] != self.labels[right][None, :]) & (d <= LOOSE)
            if close.any():
                yield some, right, d, close

    def own_pairs(self, start: int, end: int):
        """Close pairs that have this key as the first of those they share, each once."""
        for some, right, _, close in self.compared(start, end):
            a, b = (side[at] for side, at in zip((some, right), np.nonzero(close)))
            if self.p[start] == self.q[start]:  # each pair stands here twice
                a, b = (side[self.nodes[a] < self.nodes[b]] for side in (a, b))
            same = (self.sigs[a] == self.sigs[b]).reshape(len(a), CHUNKS, CHUNK)
            alike = same.sum(axis=2)
            chunk = (alike >= CHUNK - 1).argmax(axis=1)
            row = np.arange(len(a))
            out = np.where(alike[row, chunk] == CHUNK, 0, same[row, chunk].argmin(axis=1))
            first = chunk * CHUNK + out == self.keys[start] & 63
            yield a[first], b[first]


def _whole_runs(batches):
    """Rows sorted by key and blocks, in tables of whole runs."""
    held = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, now]) if held is not None else now
        columns = [np.asarray(held.column(c)) for c in ("key", "p", "q")]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        if len(new):
            yield _Rows(held.slice(0, new[-1]), [0, *new.tolist()])
            held = held.slice(new[-1]).combine_chunks()
    if held is not None and held.num_rows:
        yield _Rows(held, [0, held.num_rows])


def nearest_crossings(filed: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """For each node of a mixed key its nearest partner in another group: ``a < b``."""

    def find(batches):
        for rows in _whole_runs(batches):
            found = [(rows.nodes[:0], rows.nodes[:0], rows.nodes[:0])]
            for run in rows.runs():
                for some, right, d, close in rows.compared(*run):
                    d = np.where(close, d, SYMBOLS + 1).astype(np.int64)
                    x, y = np.flatnonzero(close.any(axis=1)), np.flatnonzero(close.any(axis=0))
                    over, down = d.argmin(axis=1)[x], d.argmin(axis=0)[y]
                    found.append((rows.nodes[some[x]], rows.nodes[right[over]], d[x, over]))
                    found.append((rows.nodes[right[y]], rows.nodes[some[down]], d[down, y]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["a", "b", "d"])

    found = _mixed_rows(filed, labels, classes).mapInArrow(find, "a long, b long, d long")
    best = found.groupBy("a").agg(F.min(F.struct("d", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def crossing_links(filed: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between different groups: every close pair is looked at, in one key each.

    ``filed`` (key, node) holds the keys with several nodes.  First the rows are kept that
    belong to some close pair; their sets then come to the key, once a row and not once a
    pair.  Groups that a link has joined here need no second one.
    """

    def keep(batches):
        for rows in _whole_runs(batches):
            used = [np.concatenate(pair) for run in rows.runs() for pair in rows.own_pairs(*run)]
            yield from rows.table.take(pa.array(np.unique(np.concatenate([np.empty(0, np.int64), *used])))).to_batches()

    def confirm(batches):
        for rows in _whole_runs(batches):
            out = []
            for run in rows.runs():
                root: dict[int, int] = {}

                def group(x, root=root):
                    while root.get(x, x) != x:
                        x = root[x]
                    return x

                for a, b in rows.own_pairs(*run):
                    order = np.argsort(a, kind="stable")
                    for part in np.split(order, np.flatnonzero(np.diff(a[order])) + 1):
                        if len(part):
                            out += _linked(rows, int(a[part[0]]), b[part], group, root, percent)
            found = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    mixed = _mixed_rows(filed, labels, classes)
    close = stage(mixed.mapInArrow(keep, mixed.schema), "close")
    rows = close.join(sets, "node").repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    return rows.mapInArrow(confirm, "a long, b long")


def _linked(rows: _Rows, one: int, others: np.ndarray, group, root: dict, percent: int):
    """Links of row ``one`` to ``others``, of each group at most one; joins the groups in ``root``."""
    mine = group(int(rows.labels[one]))
    others = np.array([i for i in others.tolist() if group(int(rows.labels[i])) != mine], np.int64)
    found = []
    if len(others):
        sets = rows.table.column("found")
        x = np.frombuffer(sets[one].as_buffer(), "<u8")
        ys = [np.frombuffer(sets[i].as_buffer(), "<u8") for i in others.tolist()]
        sizes = np.array([len(y) for y in ys])
        values = np.concatenate(ys)
        hit = x[np.minimum(np.searchsorted(x, values), len(x) - 1)] == values
        same = np.add.reduceat(hit, np.concatenate([[0], np.cumsum(sizes)[:-1]]), dtype=np.int64)
        for i in others[100 * same >= percent * (len(x) + sizes - same)].tolist():
            theirs = group(int(rows.labels[i]))
            if theirs != mine:
                root[theirs] = mine
                found.append((int(rows.nodes[one]), int(rows.nodes[i])))
    return found


def shingle_sets(docs: DataFrame, nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """``node, found``: the shingle set of each wanted class, as bytes of sorted hashes."""

    def collect(batches):
        hashes = Hashes()
        for whole in batches:
            for batch in batches_of(whole, "text"):
                sets = [shingles(t.as_py(), hashes).tobytes() for t in batch.column("text")]
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "found"])

    rows = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    wanted = rows.join(nodes.select("node").distinct(), "node", "left_semi")
    sets = wanted.mapInArrow(collect, "node long, found binary")
    return sets.dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets overlap by at least ``percent`` of their union."""

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("found").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("found").alias("y"))
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return rows.mapInArrow(check, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    component_id is the smallest doc_id that can be reached over links.  A text without
    words, or a null one, has an empty set and no links.  A row with a null id is linked
    with nothing, has a null component and is kept.  Rows that repeat an id and a text are
    one document; all of them show the same group.  Other columns play no part.
    """
    signed = stage(signatures(docs), "signed")
    linked = signed.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    classes = linked.groupBy("set_key").agg(
        F.min("doc_id").alias("node"), F.first("sig").alias("sig")
    )
    classes = stage(classes, "classes")
    keys = chunk_keys(classes)
    leaders = keys.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
    leaders = leaders.where("leader < last").select("key", "leader")
    filed = stage(keys.join(leaders, "key"), "filed")
    stars = nearest_leader(filed.where("node <> leader").select("node", "leader").distinct(), classes)
    sets = stage(shingle_sets(docs, filed.select("node"), classes), "sets")
    pairs = filed.select("key", "node")
    links = stage(confirmed(stars, sets, percent), "links")
    labels = grouped(links)
    # a copy that isn't like its leader is, as a rule, like its nearest neighbour
    links = links.union(stage(confirmed(nearest_crossings(pairs, labels, classes), sets, percent), "links"))
    labels = grouped(links)
    links = links.union(crossing_links(pairs, labels, classes, sets, percent))
    roots = components(links)
    rep = classes.select("set_key", "node")
    out = signed.join(rep, "set_key", "left").join(roots, "node", "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("root", "node", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` that are kept, one of each group, with all their columns."""
    name = free_name(docs, "keeper")
    groups = near_duplicates(docs, percent)
    gone = groups.where("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
