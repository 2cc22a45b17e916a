"""Linking noisy names to a canonical list."""

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laurel import constants as K
from laurel.functions import grams as G
from laurel.functions import predicates as P
from laurel.functions import similarity as M
from laurel.functions import spans as S
from laurel.functions import text as T
from laurel.session import stage

CHUNK = 2_000  # names handed to a task at once
ENTRIES = 4_000_000  # terms of targets, and of keys, that a task holds
PRODUCTS = 2_000_000_000  # products of a task
FILTER, SHIFTS = 1 << 20, (24, 32, 40, 48)  # 64-bit words of a key filter, and where a key's bits are read


# --- TF-IDF cosine ------------------------------------------------------------------


def counted_terms(texts: DataFrame) -> DataFrame:
    """Rows ``(id, term, tf)``, made text by text from its sorted words, so without a shuffle."""
    words = texts.select("id", F.explode(F.array(F.sort_array(M.tfidf_terms(F.col("text"))))).alias("w"))
    word = lambda i: F.get("w", i - 1)
    first = lambda i: (i == 1) | (word(i) != word(i - 1))
    marked = words.where(F.size("w") > 0).select(
        "id", "w", F.explode(F.array(F.filter(F.sequence(F.lit(1), F.size("w")), first))).alias("at")
    )
    runs = F.transform(
        "at", lambda i, j: F.struct(word(i).alias("term"), (F.coalesce(F.get("at", j + 1), F.size("w") + 1) - i).alias("tf"))
    )
    return marked.select("id", F.explode(runs).alias("r")).select("id", "r.term", "r.tf")


def _term_weights(targets: DataFrame, keys: DataFrame, total) -> DataFrame:
    """Terms of two texts or more: a number ``t``, ``idf``, and how many texts of each side hold them."""
    terms_of = lambda texts: texts.select(F.explode(F.array_distinct(M.tfidf_terms(F.col("text")))).alias("term"))
    frequency = lambda texts, name: terms_of(texts).groupBy("term").agg(F.count("*").alias(name))
    none = F.lit(0)
    return (
        frequency(keys, "kdf").join(frequency(targets, "tdf"), "term", "full")
        .select("term", F.coalesce("kdf", none).alias("kdf"), F.coalesce("tdf", none).alias("tdf"))
        .where("kdf + tdf > 1")
        .withColumn("idf", M.smooth_idf(total, F.col("kdf") + F.col("tdf")))
        .withColumn("t", F.monotonically_increasing_id())
    )


def tfidf_top_n(targets: DataFrame, keys: DataFrame, n=1, entries=ENTRIES, products=PRODUCTS) -> DataFrame:
    """The ``n`` most similar keys per target: ``(target, key, sim, rank)``.

    ``targets`` and ``keys`` have columns ``(id, text)``, ids once each.  Weights are smooth
    TF-IDF over both lists together, l2-normalised; ties go to the smaller key id; similarity
    0 never matches.  Null and empty texts match nothing but count as texts.

    Both lists are dealt into groups of about ``entries`` terms, and each group of targets
    meets each group of keys in a task, through an inverted index of the keys.  A task sends
    on the ``n`` best keys of its targets, so pairs are never shuffled.  Where terms are
    frequent, keys are dealt finer, so that a task has about ``products`` products.

    A term of a single text is in no product and has the same weight wherever it is, so
    only the others are looked up.  Lists of any length are frames only.
    """
    total = targets.select("id").unionAll(keys.select("id")).agg(F.count("*")).scalar()
    terms = stage(_term_weights(targets, keys, total), "terms")
    once, x = M.smooth_idf(total, F.lit(1)), F.col("tf") * F.col("idf")

    def vectors(texts, other, weight, name):
        entry = F.when(F.col(other) > 0, F.struct("t", weight.alias("w")))
        weighed = counted_terms(texts.where("id IS NOT NULL")).join(terms, "term", "left").withColumn("idf", F.coalesce("idf", once))
        sums = weighed.groupBy("id").agg(F.sqrt(F.sum(x * x)).alias("norm"), F.collect_list(entry).alias("e"))
        lists = sums.where(F.size("e") > 0).select(F.col("id").alias(name), "norm", F.col("e.t").alias("t"), F.col("e.w").alias("w"))
        return stage(lists, "vectors")

    sums = terms.where("kdf > 0 AND tdf > 0").agg(
        F.sum("kdf"), F.sum("tdf"), F.sum(F.col("kdf").cast("double") * F.col("tdf"))
    ).first()
    held, asked, made = (v or 0 for v in sums)
    target_groups = 1 + int(asked // entries)
    key_groups = 1 + int(max(held / entries, made / products / target_groups))
    dealt = lambda id_, groups: F.pmod(F.xxhash64(id_), F.lit(groups)).cast("int")
    every = lambda groups: F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    looked = vectors(keys, "tdf", F.col("tf"), "key")
    looked = looked.select("*", dealt("key", key_groups).alias("kg"), every(target_groups).alias("tg"))
    asking = vectors(targets, "kdf", x * F.col("idf"), "target")
    asking = asking.select("*", every(key_groups).alias("kg"), dealt("target", target_groups).alias("tg"))
    id_type = lambda texts: texts.schema["id"].dataType.simpleString()
    # by number, so that Spark doesn't put small but costly groups together
    most = 2 * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    apart = lambda rows: rows.repartition(min(4 * key_groups * target_groups, most), "kg", "tg").groupBy("kg", "tg")
    best = apart(asking).cogroup(apart(looked)).applyInArrow(
        _best_keys(n), f"target {id_type(targets)}, key {id_type(keys)}, sim double"
    )
    by_sim = Window.partitionBy("target").orderBy(F.desc(F.round("sim", 12)), "key")
    return best.withColumn("rank", F.row_number().over(by_sim)).where(F.col("rank") <= n)


def _lists(table: pa.Table):
    """The term numbers and weights of all rows one behind the other, and where each row begins and ends."""
    of = table.column("t").combine_chunks()
    weights = table.column("w").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
    ends = np.cumsum(pc.list_value_length(of).to_numpy(zero_copy_only=False)) if len(of) else np.zeros(0, np.int64)
    return of.flatten().to_numpy(), weights, np.append(0, ends)


def _best_keys(n):
    def run(targets: pa.Table, keys: pa.Table) -> pa.Table:
        keys = keys.take(pc.sort_indices(keys.column("key")))  # of equal keys the first is the smaller
        term, w, borders = _lists(keys)
        row = np.repeat(np.arange(len(keys)), np.diff(borders))
        w = w / keys.column("norm").to_numpy()[row]
        order = np.argsort(term, kind="stable")
        term, row, w = term[order], row[order], w[order]
        # a key that comes twice has a term twice
        new = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
        term, row, w = term[new], row[new], np.add.reduceat(w, new) if len(new) else w
        begins = np.flatnonzero(np.diff(term, prepend=-1))
        listed, ends = term[begins], np.append(begins[1:], len(term))

        asked, weight, borders = _lists(targets)
        weight = weight / targets.column("norm").to_numpy()[np.repeat(np.arange(len(targets)), np.diff(borders))]
        at = np.searchsorted(listed, asked)
        there = np.append(listed, -1)[at] == asked
        found, sums = [], np.zeros(len(keys))
        for i in range(len(targets)):
            sums[:] = 0
            own = slice(borders[i], borders[i + 1])
            for j, x in zip(at[own][there[own]], weight[own][there[own]]):
                begin, end = begins[j], ends[j]
                sums[row[begin:end]] += x * w[begin:end]
            least = np.partition(sums, -n)[-n] if len(sums) > n else 0
            near = np.flatnonzero((sums > 0) & (sums >= least - 1e-12))
            best = near[np.lexsort((near, -np.round(sums[near], 12)))[:n]]
            found.append((np.full(len(best), i), best, sums[best]))
        target, key, sim = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        columns = [targets.column("target").take(pa.array(target)), keys.column("key").take(pa.array(key)), pa.array(sim)]
        return pa.table(columns, ["target", "key", "sim"])

    return run


def link_values(awards: DataFrame, values: DataFrame, n=1) -> DataFrame:
    """Canonical awards with the values of their ``n`` most similar extracted awards.

    ``awards`` has one column ``award``; ``values`` has ``award`` (unique) and any value
    columns.  Rows ``(award, rank, key, sim, <values>)``; every award stays, with nulls if
    nothing is similar.
    """
    # reduced frames that the plan reads several times: compute their posts once
    values = stage(values, "values")
    as_text = [F.col("award").alias("id"), F.col("award").alias("text")]
    best = tfidf_top_n(awards.select(*as_text), values.select(*as_text), n)
    found = best.join(values.withColumnRenamed("award", "key"), "key").withColumnRenamed(
        "target", "award"
    )
    return awards.select("award").join(found, "award", "left")


# --- token-set ratio ----------------------------------------------------------------


def token_set_best(targets: DataFrame, keys: DataFrame, chunk=CHUNK, ignore_case=True) -> DataFrame:
    """The key with the highest token-set ratio per target: ``(target, key, score)``.

    ``targets`` has a column ``target``, ``keys`` a column ``key``.  The score has no
    useful block, so each task compares its keys with the canonical list and sends on
    only the best key per target, never the pairs.  The list is handed to the tasks in
    chunks of at most ``chunk`` names; a longer list means more passes, not larger ones.
    Scores of 0 give no match; ties go to the smaller key.
    """
    distinct_keys = keys.select("key").where(F.col("key").isNotNull()).distinct()
    ids = Window.orderBy("target")
    numbered = targets.select("target").distinct().withColumn("i", F.row_number().over(ids) - 1)
    n_targets = targets.select("target").distinct().count()
    passes = []
    for start in range(0, max(n_targets, 1), chunk):
        names = [
            r.target for r in numbered.where(F.col("i").between(start, start + chunk - 1)).collect()
        ]
        passes.append(distinct_keys.mapInPandas(_best_in_task(names, ignore_case), "target string, key string, score double"))
    best = (
        reduce(DataFrame.unionByName, passes)
        .groupBy("target")
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "key")).alias("b"))
        .select("target", F.col("b.key").alias("key"), (-F.col("b.s")).alias("score"))
    )
    return targets.select("target").distinct().join(best, "target", "left")


def _best_in_task(names, ignore_case):
    def run(batches):
        fold = str.lower if ignore_case else str
        folded = [(name, fold(name)) for name in names]
        best = {}
        for batch in batches:
            for key in batch["key"]:
                low = fold(key)
                for name, low_name in folded:
                    score = M.token_set_ratio(low_name, low)
                    if score <= 0:
                        continue
                    old = best.get(name)
                    if old is None or (-score, key) < (-old[1], old[0]):
                        best[name] = (key, score)
        rows = [(name, key, score) for name, (key, score) in best.items()]
        yield pd.DataFrame(rows, columns=["target", "key", "score"])

    return run


# --- containment ----------------------------------------------------------------------


WORD = r"[\p{L}\p{N}_]+"
INNER_WORD = r"(?<=[^\p{L}\p{N}_])[\p{L}\p{N}_]+(?=[^\p{L}\p{N}_])"


def anchors_of(names: DataFrame, gram=6) -> DataFrame:
    """``names`` (with ``name``) and the ``key`` that any text holding the name has.

    A word inside a name is a whole word of such a text: the longest one is the key.  A name
    without one is filed under the rarest of its substrings.  ``size`` is the substring's
    length, 0 for a word.
    """
    word = S.longest(F.regexp_extract_all("name", F.lit(INNER_WORD), F.lit(0)))
    marked = stage(names.withColumn("word", word), "anchored")
    by_word = marked.where(F.col("word").isNotNull())
    by_gram = rarest_gram(marked.where(F.col("word").isNull()).drop("word"), gram)
    others = [c for c in names.columns]
    return by_word.select(*others, F.lit(0).alias("size"), _key("word", F.lit(0)).alias("key")).unionByName(
        by_gram.select(*others, F.length("gram").alias("size"), _key("gram", F.length("gram")).alias("key"))
    )


def _key(part, size):
    return F.xxhash64(size, F.col(part))


def keys_in(text, sizes):
    """The keys of all words of a text, and of its substrings of the given sizes."""
    words = F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    grams = F.flatten(
        F.transform(
            F.filter(sizes, lambda n: n > 0),
            lambda n: F.transform(grams_of(text, F.array(n)), lambda g: F.xxhash64(n, g)),
        )
    )
    return F.concat(F.transform(words, lambda w: F.xxhash64(F.lit(0), w)), grams)


def sizes_of(anchors: DataFrame):
    """The few key sizes in use, as a scalar array."""
    return anchors.agg(F.collect_set("size")).scalar()


def known_name_mentions(posts: DataFrame, names: DataFrame, gram=4) -> DataFrame:
    """Rows ``(post_id, pos, text, award)``: the name stands in the text, any case.

    Narrow rows of keys meet the names' anchors; texts join back only where one was found.
    A short list is small enough for Spark to send it to the posts; a long one is a join.
    """
    listed = names.select("award").where(F.col("award") != "").distinct()
    anchors = stage(anchors_of(listed.select("award", F.lower("award").alias("name")), gram), "anchors")
    low = posts.select("post_id", F.explode(F.array(F.lower("text"))).alias("low"), sizes_of(anchors).alias("sizes"))
    candidates = (
        low.select("post_id", F.explode(keys_in(F.col("low"), F.col("sizes"))).alias("key"))
        .join(anchors.select("key", "award"), "key")
        .select("post_id", "award")
        .distinct()
    )
    return (
        posts.select("post_id", "pos", "text")
        .join(candidates, "post_id")
        .where(P.contains_ignore_case(F.col("text"), F.col("award")))
    )


def grams_of(value, sizes):
    """Distinct substrings of the given sizes; one linear regex pass per size."""
    def of_size(n):
        pattern = F.concat(F.lit("(?s)(?=(.{"), n.cast("string"), F.lit("}))"))
        return F.array_distinct(F.regexp_extract_all(value, pattern, F.lit(1)))

    return F.flatten(F.transform(sizes, of_size))


def rarest_gram(names: DataFrame, gram=6) -> DataFrame:
    """Each ``name`` with the least frequent of its substrings of length ``gram``.

    Shorter names use three characters or, if even shorter, themselves; so there are four
    lengths at most.
    """
    length = F.length("name")
    size = F.when(length >= gram, gram).otherwise(F.least(length, F.lit(min(3, gram))))
    grams = names.select("*", F.explode(grams_of(F.col("name"), F.array(size))).alias("gram"))
    frequency = grams.groupBy("gram").agg(F.count("*").alias("f"))
    others = [c for c in names.columns if c != "name"]
    return (
        grams.join(frequency, "gram")
        .groupBy("name", *others)
        .agg(F.min(F.struct("f", "gram")).alias("m"))
        .select("name", *others, "m.gram")
    )


def gram_sizes(anchors: DataFrame):
    """The few gram lengths in use, as a scalar array."""
    return anchors.agg(F.collect_set(F.length("gram"))).scalar()


def drop_contained(names: DataFrame) -> DataFrame:
    """Distinct names that stand in no longer name.

    Containment is transitive, so testing every longer name equals testing the kept ones.
    Each name is filed under the hash of a substring that is more than half of it, a short
    name under that of the whole.  Longer names look up their substrings of the sizes in use;
    a filter of fixed size lets only those travel that some name may be filed under.  Where
    the key is a whole name, one longer name with that key is enough.  The texts decide.
    """
    distinct = names.select(F.col("award").alias("name")).where(F.col("award").isNotNull()).distinct()
    numbered = stage(distinct.where(F.col("name") != "").withColumn("id", F.monotonically_increasing_id()), "names")
    filed = stage(_filed(numbered), "keys")
    sizes = sorted(r.size for r in filed.select("size").distinct().collect())  # a name's bits bound their number
    listed = numbered.sparkSession.sparkContext.broadcast(_key_bits(filed))
    found = numbered.mapInArrow(_substring_keys(sizes, listed), "whole boolean, key long, other long, other_n long")
    found = stage(found, "found")
    one = found.where("whole").groupBy("key").agg(F.max(F.struct("other_n", "other")).alias("o")).select("key", "o.*")
    other = found.where("NOT whole").select("key", "other_n", "other")
    looking = filed.where("n = size").join(one, "key").unionByName(filed.where("n > size").join(other, "key"))
    pairs = stage(looking.where("other_n > n").select("id", "other"), "pairs")
    held = (
        pairs.join(numbered, "id")
        .join(numbered.select(F.col("id").alias("other"), F.col("name").alias("longer")), "other")
        .where(F.contains("longer", "name"))
        .select("id").distinct()
    )
    return numbered.join(stage(held, "held"), "id", "left_anti").select(F.col("name").alias("award"))


def _filed(numbered: DataFrame) -> DataFrame:
    """Rows ``(id, n, size, key)``: of a name's first, last and least substring, the one that fewest names share."""
    offered = stage(numbered.mapInArrow(_name_keys, "id long, n long, size long, key long"), "offered")
    several = offered.where("n > size")
    frequency = several.groupBy("key").agg(F.count("*").alias("f"))
    chosen = several.join(frequency, "key").groupBy("id", "n", "size").agg(F.min(F.struct("f", "key")).alias("m"))
    return offered.where("n = size").unionByName(chosen.select("id", "n", "size", "m.key"))


def _name_keys(batches):
    for batch in G.slices(batches, "name"):
        names = G.Names(batch.column("name"))
        row, key = names.keys()
        sizes = G.key_size(names.lengths)
        columns = [batch.column("id").to_numpy()[row], names.lengths[row], sizes[row], key.view(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "n", "size", "key"])


def _key_bits(filed: DataFrame) -> np.ndarray:
    """A filter of four bits a key, in one of its 64-bit words: a word a row, ``FILTER`` at most."""
    size = min(FILTER, 1 << max(4, filed.count().bit_length()))
    place = lambda shift: F.pmod(F.shiftright("key", shift), F.lit(64)).cast("int")
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), place(shift)) for shift in SHIFTS]
    both = F.bit_or(reduce(lambda x, y: x.bitwiseOR(y), bits)).alias("bits")
    found = filed.groupBy(F.pmod("key", F.lit(size)).cast("int").alias("word")).agg(both).toArrow()
    words = np.zeros(size, np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return words


def _may_be_listed(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = reduce(np.bitwise_or, (np.uint64(1) << ((keys >> np.uint64(shift)) & np.uint64(63)) for shift in SHIFTS))
    return words[keys & np.uint64(len(words) - 1)] & bits == bits


def _substring_keys(sizes, listed):
    """Keys of the substrings of each name that some name may be filed under.

    ``whole`` are those of a name's own size, given once a batch with the longest name that
    has them; the others are given once a name.
    """
    def run(batches):
        for batch in G.slices(batches, "name"):
            names, ids = G.Names(batch.column("name")), batch.column("id").to_numpy()
            order = np.argsort(-names.lengths, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            for size in sizes:
                at = np.flatnonzero(names.left >= size)
                key = names.of_size(size)[at]
                hit = _may_be_listed(listed.value, key)
                key, row = key[hit], place[names.row[at[hit]]]
                for whole in (True, False):
                    if whole:  # longest first
                        first = np.lexsort((row, key))
                        new = np.append(True, np.diff(key[first]) != 0)[: len(first)]
                        k, r = key[first][new], order[row[first][new]]
                    elif size < G.WHOLE:
                        continue
                    else:
                        both = np.unique(np.stack([key, row.astype(np.uint64)]), axis=1)
                        k, r = both[0], order[both[1].astype(np.int64)]
                    columns = [np.full(len(k), whole), k.view(np.int64), ids[r], names.lengths[r]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["whole", "key", "other", "other_n"])

    return run


def longest_first(names: DataFrame, k=None) -> DataFrame:
    ordered = names.orderBy(F.desc(F.length("award")), "award")
    return ordered if k is None else ordered.limit(k)


def award_nominees_by_name(posts: DataFrame, names: DataFrame, words=tuple(K.NOMINEE_WORDS_HOPE), spans=None) -> DataFrame:
    """Entities of nominee posts that hold a canonical award name: ``(post_id, pos, award, name, n)``.

    A span that stands twice in a post counts twice, once per matched award.
    """
    spans = S.entity_spans(F.col("text")) if spans is None else spans
    hits = known_name_mentions(posts.where(P.has_word(F.col("text"), words)), names)
    return (
        hits.select("post_id", "pos", "award", F.explode(spans).alias("name"))
        .groupBy("post_id", "pos", "award", "name")
        .agg(F.count("*").alias("n"))
    )


# --- patterns and people ------------------------------------------------------------------


def pattern_keys(names: DataFrame) -> DataFrame:
    """Rows ``(award, pattern, key)``: a text that the loose pattern fits has one of the keys as a word.

    The words of a pattern may stand apart or run together, so a chosen word of it lies in a
    text's word that is a run of the pattern's words around it.  Chosen is the word that the
    fewest patterns have, the longest of those; the keys are all runs that hold it.
    """
    listed = names.select(
        "award", T.loose_pattern(F.col("award")).alias("pattern"), T.loose_words(F.col("award")).alias("w")
    ).where(F.size("w") > 0).distinct()
    each = listed.select("award", F.posexplode("w").alias("i", "word"))
    frequency = each.groupBy("word").agg(F.count("*").alias("f"))
    chosen = each.join(frequency, "word").groupBy("award").agg(
        F.min(F.struct("f", -F.length("word"), "word", "i")).alias("m")
    ).select("award", F.col("m.i").alias("i"))
    run = lambda first, last: F.array_join(F.slice("w", first + 1, last - first + 1), "")
    runs = F.flatten(F.transform(
        F.sequence(F.lit(0), F.col("i")),
        lambda first: F.transform(F.sequence(F.col("i"), F.size("w") - 1), lambda last: run(first, last)),
    ))
    return listed.join(chosen, "award").select("award", "pattern", F.explode(F.array_distinct(runs)).alias("key"))


def _between_borders(word):
    """A word cut where the regex engine sees a word border inside it, as beside a fraction sign."""
    return F.filter(F.split(word, r"\b"), lambda p: p != "")


def _pattern_words(text, most):
    """Words of a text, and of words with borders inside all runs of up to ``most`` parts."""
    words = F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    cut = F.filter(F.transform(words, _between_borders), lambda p: F.size(p) > 1)
    runs = lambda p: F.flatten(F.transform(
        F.sequence(F.lit(1), F.size(p)),
        lambda i: F.transform(
            F.sequence(F.lit(1), F.least(most, F.size(p) - i + 1)), lambda n: F.array_join(F.slice(p, i, n), "")
        ),
    ))
    return F.array_distinct(F.concat(words, F.flatten(F.transform(cut, runs))))


def pattern_mentions(posts: DataFrame, names: DataFrame, ignore_case=False) -> DataFrame:
    """Rows ``(award, post_id, pos)``: the loose pattern of the award occurs in the post.

    Words of the posts meet the patterns' keys in one scan, however many patterns there are;
    texts join back where one was found, and the regex itself decides.  An award that is
    listed twice counts once; one without main words is never found.
    """
    keys = stage(pattern_keys(names), "patterns")
    text = F.lower("text") if ignore_case else F.col("text")
    most = keys.agg(F.coalesce(F.max(F.size(_between_borders(F.col("key")))), F.lit(1))).scalar()
    texts = posts.select("post_id", F.explode(F.array(text)).alias("t"), most.alias("most"))
    words = texts.select("post_id", F.explode(_pattern_words(F.col("t"), F.col("most"))).alias("key"))
    found = words.join(keys.select("key", "award"), "key").select("post_id", "award").distinct()
    pattern = F.concat(F.lit("(?i)" if ignore_case else ""), "pattern")
    return (
        posts.select("post_id", "pos", "text").join(found, "post_id")
        .join(keys.select("award", "pattern").distinct(), "award")
        .where(F.rlike("text", pattern)).select("award", "post_id", "pos")
    )


def known_people(named: DataFrame, people: DataFrame, pattern="born") -> DataFrame:
    """Rows whose ``name`` has a page with the pattern in its summary (any case)."""
    pages = people.where(F.col("summary").rlike(f"(?i){pattern}")).select("name")
    return named.join(pages, "name", "left_semi")


def known_people_by_role(named: DataFrame, people: DataFrame, roles=tuple(K.LOOKUP_ROLES)) -> DataFrame:
    """Rows whose award names a role and whose person's page names the same role.

    The first role of the list that the award holds is the one looked for; awards with
    none are dropped.
    """
    role = F.coalesce(*[F.when(F.col("award").contains(r), F.lit(r)) for r in roles])
    pages = people.select(
        "name",
        F.explode(
            F.filter(F.array(*[F.lit(r) for r in roles]), lambda r: F.contains(F.lower("summary"), r))
        ).alias("lookup_role"),
    )
    return (
        named.withColumn("lookup_role", role)
        .join(pages, ["name", "lookup_role"], "left_semi")
        .drop("lookup_role")
    )


def update_existing(records: DataFrame, linked: DataFrame) -> DataFrame:
    """Replace the winner of awards that already have a record; other links are ignored."""
    new = linked.where(F.col("name").isNotNull()).select("award", F.col("name").alias("new"))
    return records.join(new, "award", "left").withColumn(
        "winner", F.coalesce("new", "winner")
    ).drop("new")
