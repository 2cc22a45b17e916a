"""Source divergence audit by iceberg prefix refinement (operator 12).

A term is kept if enough documents of its language hold it.  Prefixes of terms, counted in
bytes, are refined level by level: each level counts in how many documents every prefix
occurs that extends a prefix of the level before, and drops those below the threshold.  No
term can pass where its prefix fails, so the tail of rare terms falls away while it is
short.  A term no longer than a level's width is complete there, and is kept or dropped by
its own count.  Widths double, so the number of levels is the logarithm of the longest kept
term, whatever the texts hold.

Prefixes that stay go to the next level as a key filter of fixed size; what it lets through
in vain is dropped by its own exact count.  A last scan counts the kept terms by source.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laurel.llm.common import batches_of, mix64, stage
from laurel.llm.textscan import KeyFilter, Words, byte_kinds, gather, grouped

LETTERS = {*range(65, 91), *range(97, 123), *range(128, 256)}
KINDS = byte_kinds(b"", bytes(sorted(set(range(256)) - LETTERS)))
LEAST = 3
FIRST_WIDTH = 3  # almost every shorter prefix is kept
SCALE = 1_000_000_000
TOP_TERMS = 200
SLICE = 2_000_000  # characters a task reads at once
POOL = 400_000  # rows a task holds to sum them before it sends them on; long ones count as more
PAIRS = 250_000  # pairs of sources a task works out at once


def _name_keys(names, seed):
    return np.array([xxhash.xxh3_64_intdigest(n.encode("utf-8", "surrogatepass"), seed) for n in names.to_pylist()], np.uint64)


def _prefix_keys(terms, width, lang_keys, seed=1):
    """Keys of the terms' prefixes; a complete term has another key than longer terms' prefix."""
    whole = (terms.lengths <= width).astype(np.uint64)
    return mix64(terms.hashes(seed, width) ^ lang_keys[terms.doc] ^ (whole << np.uint64(63)))


def _row_keys(width):
    """Keys of prefixes that are held as rows ``(lang, key, whole)``."""
    def keys(batch):
        langs = batch.column("lang").dictionary_encode()
        own = _name_keys(langs.dictionary, 1)[langs.indices.to_numpy()]
        texts = batch.column("key")
        terms = object.__new__(Words)
        offsets = np.append(0, np.cumsum([len(k.as_py()) for k in texts])).astype(np.int64)
        terms.data = np.frombuffer(b"".join(texts.to_pylist()) + bytes(8), np.uint8)
        terms.starts, terms.lengths, terms.doc = offsets[:-1], np.diff(offsets), np.arange(len(texts))
        whole = batch.column("whole").to_numpy(zero_copy_only=False).astype(np.uint64)
        return mix64(terms.hashes(1, width) ^ own ^ (whole << np.uint64(63)))

    return keys


def _slices(batches):
    for batch in batches:
        for part in batches_of(batch, "text", SLICE):
            terms = Words(part.column("text"), KINDS)
            if len(terms):
                yield part, terms


def _pooled(parts, names):
    """Batches of the rows of all ``parts``, the counts of equal rows summed as far as ``POOL`` reaches.

    A part is two 64-bit keys of each row, its count and its other columns.
    """
    def merged():
        first, second, n = (np.concatenate(a) for a in zip(*(h[:3] for h in held)))
        order, begins = grouped(first, second)
        some = order[begins]
        columns = [pa.concat_arrays(c).take(pa.array(some)) for c in zip(*(h[3] for h in held))]
        return first[some], second[some], np.add.reduceat(n[order], begins), columns

    weight = lambda part: len(part[0]) + sum(c.nbytes for c in part[3]) // 64
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += weight(part)
        if size > POOL:
            held = [merged()]
            size = weight(held[0])
            if 2 * size > POOL:
                yield pa.RecordBatch.from_arrays([*held[0][3], pa.array(held[0][2])], names)
                held, size = [], 0
    if held:
        *_, n, columns = merged()
        yield pa.RecordBatch.from_arrays([*columns, pa.array(n)], names)


def _refine(width, narrower, passed):
    """In how many documents each open prefix occurs; ``passed`` holds the level before."""
    def parts(batches):
        for part, terms in _slices(batches):
            langs = part.column("lang").dictionary_encode()
            code = langs.indices.to_numpy()
            own = _name_keys(langs.dictionary, 1)[code]
            if passed is not None:
                terms = terms.select(terms.lengths > narrower)
                terms = terms.select(passed.value.has(_prefix_keys(terms, narrower, own)))
                if not len(terms):
                    continue
            first = _prefix_keys(terms, width, own)
            second = _prefix_keys(terms, width, own, 2)
            order, begins = grouped(first, second, stable=True)
            # equal keys stand in the order of documents, so each new document shows as a change
            doc = terms.doc[order]
            fresh = np.append(True, doc[1:] != doc[:-1])
            fresh[begins] = True
            at = order[begins]
            some = terms.select(at)
            yield first[at], second[at], np.add.reduceat(fresh.astype(np.int64), begins), [
                langs.dictionary.take(pa.array(code[some.doc], pa.int32())),
                gather(some.data, some.starts, np.minimum(some.lengths, width)), pa.array(some.lengths <= width),
            ]

    return lambda batches: _pooled(parts(batches), ["lang", "key", "whole", "docs"])


def _texts(docs: DataFrame) -> DataFrame:
    empty = F.lit("")
    return docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("text", "lang", "source")])


def kept_terms(docs: DataFrame, least=LEAST, first_width=FIRST_WIDTH) -> DataFrame:
    """Rows ``(lang, term, docs)``: terms that at least ``least`` documents of the language hold.

    A term is a run of letters A-Z, a-z and of characters beyond ASCII, A-Z lower-cased.  Null
    texts have no terms, a null language counts as ''; a row is a document, repeated or not.
    """
    context = docs.sparkSession.sparkContext
    texts = _texts(docs).select("text", "lang")
    width, narrower, sent, kept = first_width, 0, None, []
    while True:
        found = texts.mapInArrow(_refine(width, narrower, sent), "lang string, key binary, whole boolean, docs long")
        counted = found.groupBy("key", "lang", "whole").agg(F.sum("docs").alias("docs"))
        level = stage(counted.where(F.col("docs") >= least), "prefixes")
        kept.append(level.where("whole").select("lang", F.col("key").cast("string").alias("term"), "docs"))
        open_ones = level.where("NOT whole").select("lang", "key", "whole")
        passing = KeyFilter().with_keys(open_ones, _row_keys(width))
        if sent is not None:
            sent.destroy()
        if not passing.words.any():
            break
        sent, narrower, width = context.broadcast(passing), width, 2 * width
    terms = kept[0]
    for more in kept[1:]:
        terms = terms.unionByName(more)
    return terms


def _count(passed, widest):
    """Occurrences of kept terms by language and place of the source."""
    def parts(batches):
        for part, terms in _slices(batches):
            langs = part.column("lang").dictionary_encode()
            code, place = langs.indices.to_numpy(), part.column("place").to_numpy()
            lang = _name_keys(langs.dictionary, 1)[code]
            first = _prefix_keys(terms, widest, lang)
            inside = passed.value.has(first)
            terms, first = terms.select(inside), first[inside]
            if not len(terms):
                continue
            apart = mix64(place.astype(np.uint64))[terms.doc]
            first, second = mix64(first ^ apart), mix64((terms.hashes(2) ^ lang[terms.doc]) + apart)
            order, begins = grouped(first, second)
            at = order[begins]
            some = terms.select(at)
            yield first[at], second[at], np.diff(np.append(begins, len(order))), [
                langs.dictionary.take(pa.array(code[some.doc], pa.int32())), pa.array(place[some.doc]),
                gather(some.data, some.starts, some.lengths).cast(pa.string()),
            ]

    return lambda batches: _pooled(parts(batches), ["lang", "place", "term", "n"])


def source_places(docs: DataFrame) -> DataFrame:
    """Rows ``(lang, source, place)``: the sources of a language, numbered from 0."""
    return (
        _texts(docs).select("lang", "source").distinct()
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    )


def term_counts(docs: DataFrame, kept: DataFrame, places: DataFrame) -> DataFrame:
    """Rows ``(lang, term, entries, all)``: occurrences of a kept term, by place of the source and in all.

    An entry is ``(place, n)``, one for each source of the language that has the term.
    """
    widest = 1 << 62
    rows = kept.select("lang", F.col("term").cast("binary").alias("key"), F.lit(True).alias("whole"))
    sent = docs.sparkSession.sparkContext.broadcast(KeyFilter().with_keys(rows, _row_keys(widest)))
    texts = _texts(docs).join(places, ["lang", "source"]).select("text", "lang", "place")
    found = texts.mapInArrow(_count(sent, widest), "lang string, place int, term string, n long")
    # dealt out by term once; all that follows a term stays in its task
    summed = found.repartition("term", "lang").groupBy("term", "lang", "place").agg(F.sum("n").alias("n"))
    lists = summed.groupBy("term", "lang").agg(F.collect_list(F.struct("place", "n")).alias("entries"), F.sum("n").alias("all"))
    return lists.join(kept.select("term", "lang"), ["term", "lang"], "left_semi")


def _share(count, total, size):
    """p = 1 + floor(SCALE * (count + 1) / (total + size)), exactly; 0 if nothing is kept."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    frame = F.when(total + size > 0, F.call_function("div", above, (total + size).cast("decimal(20,0)")))
    return F.coalesce(1 + frame, F.lit(0).cast("long"))


def _gap(p, q):
    """floor((p - q) * (p - q) / q)"""
    return F.call_function("div", (p - q) * (p - q), q)


def _shared_gaps(batches):
    """For each pair of sources, what their common terms add beyond the two one-sided sums.

    Rows hold a term's sources with their p and their p of an absent term.
    """
    for batch in batches:
        lists = batch.column("entries")
        flat = lists.flatten()
        group, p, p0 = (flat.field(n).to_numpy() for n in ("group", "p", "p0"))
        sizes = np.diff(lists.offsets.to_numpy())
        starts = np.cumsum(sizes) - sizes
        # each entry meets all entries of its own term
        partners = np.repeat(sizes, sizes)
        from_ = np.repeat(starts, sizes)
        ends = np.cumsum(partners)
        i = 0
        while i < len(partners):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PAIRS, "right")))
            left = np.repeat(np.arange(i, j), partners[i:j])
            begins = np.cumsum(partners[i:j]) - partners[i:j]
            right = np.arange(len(left)) + np.repeat(from_[i:j] - begins, partners[i:j])
            apart = left != right
            left, right = left[apart], right[apart]
            gap = lambda a, b: (a - b) * (a - b) // b
            value = gap(p[left], p[right]) - gap(p[left], p0[right]) - gap(p0[left], p[right]) + gap(p0[left], p0[right])
            i = j
            if not len(left):
                continue
            order = np.lexsort((group[right], group[left]))
            a, b = group[left][order], group[right][order]
            new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[new]), pa.array(b[new]), pa.array(np.add.reduceat(value[order], new))], ["a", "b", "value"]
            )


def _contenders(top):
    """Drops rows that at least ``top`` rows of their group surpass in value."""
    def run(batches):
        best = np.empty(0, np.int64), np.empty(0, np.int64)  # group and value of the first rows so far
        for batch in batches:
            group, value = batch.column("group").to_numpy(), batch.column("value").to_numpy()
            both = [np.concatenate(c) for c in zip(best, (group, value))]
            order = np.lexsort((-both[1], both[0]))
            groups, values = both[0][order], both[1][order]
            begins = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))[: len(groups)]
            sizes = np.diff(np.append(begins, len(groups)))
            in_front = np.arange(len(groups)) - np.repeat(begins, sizes) < top
            best = groups[in_front], values[in_front]
            # the least value that may still be among the first
            least = values[begins + np.minimum(sizes, top) - 1]
            bar = np.where(sizes >= top, least, np.iinfo(np.int64).min)
            keep = value >= bar[np.searchsorted(groups[begins], group)]
            yield batch.filter(pa.array(keep))

    return run


def audit(docs: DataFrame, least=LEAST, top=TOP_TERMS, first_width=FIRST_WIDTH) -> DataFrame:
    """How far each source's terms lie from other sources and from its language.

    Rows ``(lang, source, part, item, value, rank)``.  A group is a language's source; it gives
    each kept term p = 1 + floor(SCALE * (count + 1) / (N + V)), with N its kept-term count and
    V the number of kept terms.  Part ``pair``: the sum of floor((p - q)^2 / q) over all kept
    terms for each other source (q) of the language, 0 if no term is kept.  Part ``term``: the
    first ``top`` terms of the group that it uses more than its language does (q).  Ranks from
    1 by value falling, item rising by UTF-8 bytes.  Null text, lang and source count as '';
    every group that occurs has its pairs, even without terms; a language of one source has
    no pairs.  Other columns play no part; an empty table gives no rows.
    """
    kept = kept_terms(docs, least, first_width)
    places = stage(source_places(docs), "places")
    counts = stage(term_counts(docs, kept, places), "term-counts")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    sums = (
        counts.select("lang", F.explode("entries").alias("e")).groupBy("lang", F.col("e.place").alias("place"))
        .agg(F.sum("e.n").alias("total"))
    )
    groups = (
        places.join(sums, ["lang", "place"], "left").join(sizes, "lang", "left")
        .select("lang", "source", "place", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"))
        .withColumn("p0", _share(F.lit(0), F.col("total"), F.col("v")))
        .withColumn("group", F.monotonically_increasing_id())
    )
    groups = stage(groups, "groups")
    # written first: Spark then knows how small it is, and needn't deal the terms by language
    langs = stage(
        groups.groupBy("lang").agg(
            F.sort_array(F.collect_list(F.struct("place", "group", "total", "p0"))).alias("sources"),
            F.sum("total").alias("lang_total"), F.first("v").alias("v"),
        ), "langs",
    )

    def share_of(entry):
        own = F.col("sources")[entry["place"]]
        return F.struct(
            own["group"].alias("group"), _share(entry["n"], own["total"], F.col("v")).alias("p"), own["p0"].alias("p0")
        )

    terms = stage(
        counts.join(langs, "lang").select(
            "term", F.transform("entries", share_of).alias("entries"), _share(F.col("all"), F.col("lang_total"), F.col("v")).alias("q")
        ), "shares",
    )
    each = terms.select("term", "q", F.inline("entries"))

    pairs = groups.alias("a").join(
        groups.alias("b"), (F.col("a.lang") == F.col("b.lang")) & (F.col("a.group") != F.col("b.group"))
    )
    ids = [F.col("a.group").alias("a"), F.col("b.group").alias("b")]
    absent = _gap(F.col("a.p0"), F.col("b.p0"))
    nothing = pairs.where("a.v > 0").select(*ids, (F.col("a.v") * absent).alias("value"))
    # terms of one side only come from how often each share occurs there
    shares = stage(each.groupBy(F.col("group").alias("own"), "p").agg(F.count(F.lit(1)).alias("terms")), "share-counts")
    used = pairs.join(shares, F.col("a.group") == F.col("own")).select(
        *ids, (F.col("terms") * (_gap(F.col("p"), F.col("b.p0")) - absent)).alias("value")
    )
    missed = pairs.join(shares, F.col("b.group") == F.col("own")).select(
        *ids, (F.col("terms") * (_gap(F.col("a.p0"), F.col("p")) - absent)).alias("value")
    )
    # a list holds each source of the language once at most
    both = terms.where(F.size("entries") > 1).select("entries").mapInArrow(_shared_gaps, "a long, b long, value long")
    gaps = nothing.unionByName(used).unionByName(missed).unionByName(both).groupBy("a", "b").agg(F.sum("value").alias("value"))
    pair_rows = pairs.join(gaps, (F.col("a.group") == gaps["a"]) & (F.col("b.group") == gaps["b"]), "left").select(
        "a.lang", "a.source", F.lit("pair").alias("part"), F.col("b.source").alias("item"),
        F.coalesce("value", F.lit(0)).alias("value"),
    )

    above = each.where("p > q").select("group", _gap(F.col("p"), F.col("q")).alias("value"), F.col("term").alias("item"))
    first = above.mapInArrow(_contenders(top), "group long, value long, item string")
    term_rows = first.join(groups.select("group", "lang", "source"), "group").select(
        "lang", "source", F.lit("term").alias("part"), "item", "value"
    )

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    return ranked(pair_rows).unionByName(ranked(term_rows).where(F.col("rank") <= top))
