"""Operators on documents against brute force, on small frames with odd rows."""

import collections
import hashlib
import itertools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from laurel import session
from laurel.llm import digest_index, gam_quality, hamming_dedup, hpylm, language_id, mixing, packing
from laurel.llm.common import held_out

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, digest string, language string, epoch int"
BASE = "the quick brown fox jumps over the lazy dog while ten small birds sing near an old stone bridge by the river"


def frame(spark, rows, shape=SHAPE):
    width = len(shape.split(","))
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], shape)


def near_copy(n):
    words = BASE.split() * 3
    words[n % len(words)] = f"word{n}"
    return " ".join(words)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, "Same  text\there", "en", "src1"), (2, "Same text here", "en", "src1"), (2, "Same text here", "en", "src1"),
        (3, None, None, None), (4, "", "en", "src2"), (5, "   ", "en", "src2"), (None, "Same text here", "en", "src0"),
        (None, "no id at all", "en", "src0"), (6, "1234 5678 !!", "en", "src3"), (7, "one two", "fr", "src1"),
        (8, "One\nTWO", "fr", "src1"), (9, BASE * 400, "en", "src2"),
    ]
    rows += [(100 + i, near_copy(i), "en", "src0") for i in range(30)]
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def collected(df):
    return [tuple(r) for r in df.collect()]


# --- exact dedup -------------------------------------------------------------------

def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_digest_index_against_brute_force(odd, empty, spark):
    rows = [(r.doc_id, plain(r.text)) for r in odd.collect()]
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    want = []
    for i, t in rows:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        want.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    got = collected(digest_index.DigestIndex(spark).add(odd))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert digest_index.DigestIndex(spark).add(empty).count() == 0


def test_later_batches_meet_the_index(spark):
    index = digest_index.DigestIndex(spark, buckets=4)
    index.add(frame(spark, [(10, "a b"), (11, "c")])).collect()
    again = digest_index.DigestIndex(spark, index.name, buckets=4)
    got = {r.doc_id: r for r in again.add(frame(spark, [(1, "a  b"), (2, "d"), (3, "d")])).collect()}
    assert (got[1].keep_id, got[1].kept, got[1].group_size) == (10, False, 1)
    assert (got[2].kept, got[3].kept, got[3].keep_id) == (True, False, 2)
    assert again.table().count() == 3
    assert digest_index.exact_dedup(frame(spark, [(5, "c"), (6, "new"), (6, "new")]), again).count() == 1


def test_the_index_outlives_its_session(spark):
    """A later session has another catalog and other settings; the files are the index."""
    first = digest_index.DigestIndex(spark, buckets=4)
    first.add(frame(spark, [(10, "same text"), (11, "c")])).collect()
    first.close()
    assert not spark.catalog.tableExists(first.name)
    later = spark.newSession()
    later.conf.set("spark.sql.shuffle.partitions", "3")
    index = digest_index.DigestIndex(later, first.name)
    assert (index.buckets, index.batches) == (4, 1)
    got = {r.doc_id: r for r in index.add(frame(later, [(1, "same  text"), (2, "d")])).collect()}
    assert (got[1].keep_id, got[1].kept, got[2].kept) == (10, False, True)
    assert sorted(r.batch for r in index.table().collect()) == [1, 1, 2]
    with pytest.raises(ValueError):
        digest_index.DigestIndex(later, first.name, buckets=8)


def test_a_failed_batch_is_added_again(spark):
    index = digest_index.DigestIndex(spark, buckets=4)
    index.add(frame(spark, [(10, "a")])).collect()
    batch = [(1, "a"), (2, "b"), (3, "b"), (4, "c")]
    # the first try writes a part of its digests and dies
    index._register(frame(spark, batch[:2]).select("doc_id", digest_index.text_digest(F.col("text")).alias("digest")), 2)
    again = digest_index.DigestIndex(spark, index.name)
    got = {r.doc_id: (r.keep_id, r.kept) for r in again.add(frame(spark, batch), batch=2).collect()}
    assert got == {1: (10, False), 2: (2, True), 3: (2, False), 4: (4, True)}
    assert again.table().count() == 3
    kept = digest_index.exact_dedup(frame(spark, batch), again, batch=2)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4]


def test_no_table_is_left_in_the_catalog(spark, odd):
    before = {t.name for t in spark.catalog.listTables()}
    kept = digest_index.exact_dedup(odd)
    assert kept.count() > 0 and {t.name for t in spark.catalog.listTables()} == before


def test_exact_dedup_keeps_one_row_and_all_columns(odd):
    kept = digest_index.exact_dedup(odd)
    assert kept.columns == odd.columns
    texts = [plain(r.text) for r in odd.collect()]
    assert kept.count() == len(set(texts))


# --- near duplicates ---------------------------------------------------------------

def shingle_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def brute_groups(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in itertools.combinations([s for s in sets if s[0] is not None and s[1]], 2):
        if 100 * len(a & b) >= 75 * len(a | b):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def test_near_duplicates_against_brute_force(odd, empty):
    got = hamming_dedup.near_duplicates(odd).collect()
    want = brute_groups([(r.doc_id, r.text) for r in odd.collect()])
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    assert hamming_dedup.near_duplicates(empty).count() == 0


def test_chain_of_edits_is_one_group(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):  # each differs a little from the one before, first and last have nothing in common
        rows.append((1000 - i, " ".join(words)))
        for j in rng.integers(0, 120, 2):
            words[j] = f"x{i}_{j}"
    got = hamming_dedup.near_duplicates(frame(spark, rows)).collect()
    want = {i: c for i, _, c in brute_groups(rows)}
    assert {r.doc_id: r.component_id for r in got} == want


def test_large_key_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(hamming_dedup, "BLOCK", 16)
    rows = [(i, f"{BASE} {BASE.replace('the', f'a{i // 2}')}") for i in range(80)]
    got = hamming_dedup.near_duplicates(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_groups(rows)


def test_every_pair_within_the_distance_shares_a_key(spark):
    rng = np.random.default_rng(1)
    one = rng.integers(0, 1 << 16, hamming_dedup.SYMBOLS).astype("<u2")
    rows = [(0, one.tobytes())]
    for i in range(1, 40):
        other = one.copy()
        at = rng.choice(hamming_dedup.SYMBOLS, hamming_dedup.MOST_APART, replace=False)
        other[at] ^= 1
        rows.append((i, other.tobytes()))
    keys = hamming_dedup.chunk_keys(spark.createDataFrame([(n, bytearray(s)) for n, s in rows], "node long, sig binary"))
    found = collections.defaultdict(set)
    for r in keys.collect():
        found[r.node].add(r.key)
    assert all(found[0] & found[i] for i in range(1, 40))


def test_pairs_that_share_a_key_are_confirmed_far_apart(spark):
    one = np.arange(hamming_dedup.SYMBOLS, dtype="<u2")
    other = one.copy()
    other[-(hamming_dedup.MOST_APART + 5) :] += 1000  # 32 symbols; similar sets have that at times
    classes = spark.createDataFrame([(1, bytearray(one.tobytes())), (2, bytearray(other.tobytes()))], "node long, sig binary")
    found = [(i, bytearray(np.arange(n, dtype="<u8").tobytes())) for i, n in ((1, 75), (2, 100))]
    sets = spark.createDataFrame(found, "node long, found binary")
    filed, labels = hamming_dedup.chunk_keys(classes), spark.createDataFrame([], "node long, root long")
    pairs = spark.createDataFrame([(2, 1)], "node long, leader long")
    assert collected(hamming_dedup.nearest_leader(pairs, classes)) == [(1, 2)]
    assert collected(hamming_dedup.nearest_crossings(filed, labels, classes)) == [(1, 2)]
    assert [sorted(r) for r in collected(hamming_dedup.crossing_links(filed, labels, classes, sets, 75))] == [[1, 2]]


# --- language ----------------------------------------------------------------------

def brute_grams(text, most):
    count = collections.Counter()
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        edged = "\x01" + word + "\x01"
        for n in (1, 2, 3):
            for i in range(len(edged) - n + 1):
                gram = edged[i : i + n]
                if gram != "\x01":
                    count[gram] += 1
    code = lambda g: sum(ord(c) << (21 * k) for k, c in enumerate(reversed(g)))
    return [code(g) for g, _ in sorted(count.items(), key=lambda x: (-x[1], code(x[0])))][:most]


def test_document_profile_against_brute_force():
    for text in ("Été à Paris, 2 fois!", BASE, "a", "ab12ab", None, "", "...", "日本語 テキスト"):
        assert language_id.top_grams(text, 50).tolist() == brute_grams(text, 50)


def test_long_texts_are_read_in_blocks(monkeypatch):
    whole = language_id.top_grams(BASE * 20, 300).tolist()
    monkeypatch.setattr(language_id, "BLOCK", 37)
    assert language_id.top_grams(BASE * 20, 300).tolist() == whole


def test_languages_are_told_apart(spark, odd, empty):
    rows = [(i, f"{BASE} number {i}", "en") for i in range(20)]
    rows += [(i + 50, f"le chat noir dort sur la grande table près de la fenêtre ouverte {i}", "fr") for i in range(20)]
    docs = frame(spark, rows)
    profiles = language_id.learn_profiles(docs.where(~held_out("doc_id", 4, 2)))
    assert [lang for lang, _ in profiles] == ["en", "fr"]
    found = language_id.identify(docs.drop("language"), profiles).collect()
    assert all(r.language.lang == r.lang and 0 < r.language.score <= 1 for r in found)
    odd_ones = {r.doc_id: r.language for r in language_id.identify(odd.drop("language"), profiles).collect() if r.doc_id}
    assert [odd_ones[i].lang for i in (3, 4, 6)] == ["und"] * 3 and odd_ones[3].score == 0
    assert odd_ones[9].lang == "en"
    nothing = language_id.learn_profiles(empty)
    assert {r.language.lang for r in language_id.identify(docs.drop("language"), nothing).collect()} == {"und"}


# --- packing -----------------------------------------------------------------------

def test_bytes_of_tokens_equal_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    words = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"), 3)  # words are forgotten and made again
    for text in ("", None, "Plain words, it's 42 plain words", "caf\u00e9 \u4f60\u597d\tb\nc", "a <|endoftext|> b"):
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids, "<u4")
        assert words.encoded(text) == ids.tobytes()


def test_pieces_equal_the_tokenizer(odd):
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["It's  DON'T\tÉtÉ ß x²½ ªº <|endoftext|> a<|b", "日本 ὈΔΥΣΣΕΎΣ İ ﬁ é", "", None, "...!!a1b2\x1cq\x85z", BASE]
    words = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    for text in texts:
        assert words.encode(text) == whole.encode(text or "", add_special_tokens=False).ids
    got = collections.defaultdict(list)
    for r in packing.token_pieces(odd, 64, with_ids=True).collect():
        got[r.doc_id].append(r)
    ids = whole.encode(BASE * 400, add_special_tokens=False).ids + [1]
    parts = sorted(got[9], key=lambda r: r.piece)
    assert [i for r in parts for i in r.ids] == ids and all(r.length == 64 for r in parts[:-1])
    assert parts[1].start == 64 and parts[1].ids_crc32 == zlib.crc32(np.array(parts[1].ids, "<u4").tobytes())
    assert [r.length for r in got[3]] == [1]


def check_plan(lengths, size):
    counts = np.bincount(lengths, minlength=size + 1) if lengths else np.zeros(size + 1, int)
    plan = packing.solve(counts, size)
    bins = collections.defaultdict(list)
    placed = collections.Counter()
    for length, first, count, bin_, each, offset in plan.records:
        assert first == placed[length]
        placed[length] += count
        for k in range(count):
            bins[bin_ + k // each].append((offset + k % each * length, length))
    assert placed == collections.Counter(lengths)
    for inside in bins.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def best_packing(lengths, size):
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i] and rooms[k] not in rooms[:k]:
                go(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1 :])
        go(i + 1, [*rooms, size - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    go(0, [])
    return best


def test_reduction_keeps_a_best_packing():
    rng = np.random.default_rng(5)
    for _ in range(150):
        size = int(rng.integers(6, 30))
        lengths = [int(x) for x in rng.integers(1, size + 1, int(rng.integers(1, 9)))]
        plan = packing.Plan()
        left = packing.fixed_sets(np.bincount(lengths, minlength=size + 1), size, plan)
        rest = [n for n, c in enumerate(left) for _ in range(c)]
        assert plan.bins + (best_packing(rest, size) if rest else 0) == best_packing(lengths, size)
        assert check_plan(lengths, size) >= best_packing(lengths, size)


def test_plans_of_many_shapes():
    rng = np.random.default_rng(6)
    for n, top in ((0, 50), (2000, 64), (3000, 20), (500, 33)):
        lengths = [int(x) for x in rng.integers(1, top + 1, n)]
        assert check_plan(lengths, 64) >= math.ceil(sum(lengths) / 64)


def test_packed_pieces_fill_sequences(odd, empty):
    rows = packing.pack_documents(odd, 128, with_ids=True)
    got = rows.collect()
    assert len(got) == packing.token_pieces(odd, 128).count()
    for _, inside in itertools.groupby(sorted(got, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in inside:
            assert r.offset == at
            at += r.length
        assert at <= 128
    made = {r.sequence_id: r for r in packing.sequences(rows).collect()}
    assert all(list(made[r.sequence_id].ids[r.offset : r.offset + r.length]) == list(r.ids) for r in got)
    assert packing.pack_documents(empty).count() == 0


# --- quality -----------------------------------------------------------------------

def test_quality_finds_planted_junk(spark, odd, empty):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(400):
        words = [w if rng.random() < 0.7 else w[::-1] for w in rng.permutation(BASE.split())]
        bad = i % 4 == 0
        rows.append((i, " ".join(w + "###" if bad else w for w in words)))
        labels.append((i, 0 if bad else 1, 0))
    marks = frame(spark, [*labels, (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    gam = gam_quality.learn(docs, marks.where("doc_id < 300 OR doc_id IS NULL"))
    scored = docs.select("doc_id", gam_quality.quality_of(F.col("text"), gam).alias("score")).collect()
    assert all((r.score < 0.3) == (r.doc_id % 4 == 0) for r in scored if r.doc_id >= 300)
    others = odd.select(gam_quality.quality_of(F.col("text"), gam).alias("score")).collect()
    assert all(0 <= r.score <= 1 for r in others)
    blank = gam_quality.learn(empty, marks.where("false"))
    assert {r.score for r in docs.select(gam_quality.quality_of(F.col("text"), blank).alias("score")).collect()} == {0.5}


# --- language model ----------------------------------------------------------------

def brute_base(rows):
    tokens = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [b"\n"]
    count = collections.Counter(w for _, t, held in rows if not held for w in tokens(t))
    total, kinds = sum(count.values()), len(count)
    out = []
    for i, t, held in rows:
        words = tokens(t)
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words)
        out.append((i, held, len(words), sum(count[w] > 0 for w in words), total, round(base, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("common", [8, 32_768])
def test_counts_and_base_against_brute_force(odd, empty, monkeypatch, common):
    monkeypatch.setattr(hpylm, "COMMON", common)
    words = hpylm.common_words
    monkeypatch.setattr(hpylm, "common_words", lambda docs: words(docs, common))
    held = held_out("doc_id", 5, 1)
    got = hpylm.score_documents(odd, held).collect()
    rows = [(r.doc_id, r.text, r.h) for r in odd.select("doc_id", "text", held.alias("h")).collect()]
    have = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(have, key=repr) == brute_base(rows)
    assert all(r.score < 0 for r in got)
    assert hpylm.score_documents(empty, held).count() == 0


def test_chances_of_a_context_add_up_to_one():
    contexts = hpylm.CONTEXTS + 1
    rng = np.random.default_rng(4)
    word, context = np.divmod(np.unique(rng.integers(0, contexts * 40, 900)), contexts)
    dishes = hpylm.Dishes(word, context, rng.integers(1, 200, len(word)), 40)
    for _ in range(3):
        dishes.sweep(dishes.totals(), rng)
    totals = dishes.totals()
    seen = hpylm._common_chances(dishes, totals).sum(axis=1)
    novel = totals.known(np.arange(contexts), 0, 0, totals.root(0, 0, hpylm.NOVEL))
    assert np.allclose(seen + novel, 1)


def test_tables_follow_the_restaurant_rule():
    rng = np.random.default_rng(7)
    n, appeal, discount = 400, 2.0, 0.6
    want = []
    for _ in range(3000):
        tables = 1
        for j in range(1, n):
            tables += rng.random() * (appeal + j - discount * tables) < appeal
        want.append(tables)
    got = hpylm.seat(np.full(3000, n), np.full(3000, appeal), discount, rng)
    assert abs(np.mean(got) - np.mean(want)) < 0.5
    assert hpylm.seat(np.array([0, 1]), np.ones(2), discount, rng).tolist() == [0, 1]


def test_the_word_before_counts_however_rare(spark):
    rng = np.random.default_rng(8)
    said = lambda shift: " ".join(f"a{i} b{(i + shift) % 150}" for i in rng.permutation(150))
    rows = [(i, said(0)) for i in range(12)] + [(100, said(0)), (101, said(7))]
    got = {r.doc_id: r for r in hpylm.score_documents(frame(spark, rows), F.col("doc_id") >= 100).collect()}
    # the words are equally frequent, and only the right pairs were seen
    assert got[100].base_score == pytest.approx(got[101].base_score)
    assert got[100].score > got[101].score + 50


def test_sweeps_leave_no_tables_behind(spark):
    before = session.stages()
    scored = hpylm.score_documents(frame(spark, [(i, f"a b c{i % 3}") for i in range(30)]), F.col("doc_id") % 5 == 1)
    assert session.stages() == before + 1  # the chances
    assert scored.count() == 30


def in_memory(rows, seed=1):
    """Scores by ``Dishes``: all pairs in memory."""
    tokens = lambda t: [*t.split(), "\n"]
    number = {w: i for i, w in enumerate({w: 0 for _, t, _ in rows for w in tokens(t)})}
    pairs = lambda t: list(zip(["\n", *t.split()], tokens(t)))
    count = collections.Counter((number[w], number[c]) for _, t, held in rows if not held for c, w in pairs(t))
    word, context, n = (np.array(c) for c in zip(*((*k, v) for k, v in sorted(count.items()))))
    dishes, rng = hpylm.Dishes(word, context, n, len(number), len(number)), np.random.default_rng(seed)
    chance = 0
    for i in range(hpylm.SWEEPS):
        dishes.sweep(dishes.totals(), rng)
        if i >= hpylm.BURN_IN:
            totals = dishes.totals()
            now = hpylm._common_chances(dishes, totals)
            novel = totals.known(np.arange(len(number)), 0, 0, totals.root(0, 0, hpylm.NOVEL))
            seen = np.bincount(word, minlength=len(number)) > 0
            chance = chance + np.where(seen, now, novel[:, None]) / (hpylm.SWEEPS - hpylm.BURN_IN)
    return {i: sum(math.log10(chance[number[c], number[w]]) for c, w in pairs(t)) for i, t, _ in rows}


@pytest.mark.parametrize("common", [4, 32_768])
def test_scores_do_not_depend_on_how_words_are_counted(spark, monkeypatch, common):
    words = hpylm.common_words
    monkeypatch.setattr(hpylm, "common_words", lambda docs: words(docs, common))
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.pareto(0.7, 80) if x < 1e4), i % 5 == 1) for i in range(60)]
    got = hpylm.score_documents(frame(spark, [r[:2] for r in rows]), F.col("doc_id") % 5 == 1).collect()
    want = in_memory(rows)
    assert all(abs(r.score - want[r.doc_id]) < 0.02 * abs(want[r.doc_id]) for r in got)
    assert abs(sum(r.score for r in got) / sum(want.values()) - 1) < 0.003


def test_many_buckets_give_the_same_scores(spark, monkeypatch):
    words = hpylm.common_words
    monkeypatch.setattr(hpylm, "common_words", lambda docs: words(docs, 4))
    monkeypatch.setattr(hpylm, "BUCKET_CHARS", 2_000)
    rng = np.random.default_rng(10)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.pareto(0.7, 80) if x < 1e4), i % 5 == 1) for i in range(60)]
    got = hpylm.score_documents(frame(spark, [r[:2] for r in rows]), F.col("doc_id") % 5 == 1).collect()
    want = in_memory(rows)
    assert all(abs(r.score - want[r.doc_id]) < 0.02 * abs(want[r.doc_id]) for r in got)
    assert abs(sum(r.score for r in got) / sum(want.values()) - 1) < 0.003


def test_sums_of_common_words_travel_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(hpylm, "BUCKET_CHARS", 10_000)
    rows_of, stage = {}, hpylm.stage

    def counted(df, name="stage"):
        out = stage(df, name)
        rows_of[name] = out.count()
        return out

    monkeypatch.setattr(hpylm, "stage", counted)
    rng = np.random.default_rng(12)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.integers(0, 900, 100))) for i in range(200)]
    scored = hpylm.score_documents(frame(spark, rows), F.lit(False))
    # every bucket has nearly all of 900 common words, whose sums were a row each
    assert 0 < rows_of["dishes"] < 200 and 0 < rows_of["swept"] < 200
    assert {r.n_known for r in scored.collect()} == {101}


def test_pairs_travel_in_few_bytes_and_come_back_whole():
    rng = np.random.default_rng(13)
    rare = -rng.integers(1, 2**62, 300)
    context, word = (np.where(rng.random(5000) < 0.2, rng.choice(rare, 5000), rng.integers(0, hpylm.COMMON, 5000)) for _ in range(2))
    n = rng.integers(-3, 2**31 - 1, 5000)
    some = [(0, 2000), (2000, 2001), (2001, 5000)]
    batch = hpylm.rows_of(hpylm.PIECE, [4] * 3, [7, 8, 9], arrays=[hpylm.packed(context[i:j], word[i:j], n[i:j], n[i:j] * 0 + 1) for i, j in some])
    *got, sizes = hpylm.unpacked(batch)
    assert all(np.array_equal(a, b) for a, b in zip(got, (context, word, n, n * 0 + 1)))
    assert sizes.tolist() == [j - i for i, j in some]
    assert batch.nbytes < 12 * 5000  # 40 with eight bytes a number


def test_equal_pairs_of_a_document_are_summed_and_dealt():
    rng = np.random.default_rng(14)
    context, word, doc = rng.integers(-5, 6, 6000), rng.integers(-5, 6, 6000), np.sort(rng.integers(0, 70_000, 6000) // 9000 * 9000)
    bucket, c, w, d, n = hpylm._dealt(7, context, word, doc, np.ones(6000, np.int64))
    assert np.all(np.diff(bucket) >= 0) and np.array_equal(bucket, hpylm.buckets_of(c, w, 7))
    got = collections.Counter()
    for key, x in zip(zip(c.tolist(), w.tolist(), d.tolist()), n.tolist()):
        got[key] += x
    assert got == collections.Counter(zip(context.tolist(), word.tolist(), doc.tolist()))


def test_rare_words_have_all_dishes_in_one_bucket():
    rng = np.random.default_rng(11)
    context, word = rng.integers(-9, 9, 4000), rng.integers(-9, 9, 4000)
    bucket = hpylm.buckets_of(context, word, 50)
    assert all(len(set(bucket[word == w])) == 1 for w in range(-9, 0))
    assert all(len(set(bucket[(word >= 0) & (context == c)])) == 1 for c in range(-9, 0))
    assert len(set(bucket[(word >= 0) & (context >= 0)])) > 30


# --- mixing ------------------------------------------------------------------------

def test_shortage_stays_among_siblings(spark):
    leaves = frame(spark, [("d0", "en", "a", 100), ("d0", "en", "b", 10), ("d0", "fr", "c", 1000), ("d1", "en", "d", 1000)],
                   "domain string, lang string, source string, tokens long")
    got = {r.source: r.given for r in mixing.allocate(leaves, 0.5, 1, ("1", "1", "1")).collect()}
    # 1055: 527 a domain; d0: 263 a language, but en has 110, so fr takes 417
    assert got == {"a": 100, "b": 10, "c": 417, "d": 527}
    got = {r.source: r.given for r in mixing.allocate(leaves, 1.0, 1, ("1", "1", "1")).collect()}
    assert got == {"a": 100, "b": 10, "c": 1000, "d": 1000}


def test_mix_takes_prefixes_within_the_budget(odd, empty, spark):
    docs = frame(spark, [(i, "w " * (1 + i % 7), "en" if i % 3 else "fr", f"src{i % 5}") for i in range(400)]).drop("epoch")
    total = sum(1 + i % 7 for i in range(400))
    for budget, epochs in ((0.3, 1), (1.7, 2), (0.8, 3)):
        got = mixing.mix(docs, budget, epochs, epoch_column="epoch").collect()
        assert budget * total * 0.9 <= sum(len(r.text.split()) for r in got) <= budget * total
        seen = collections.Counter(r.doc_id for r in got)
        assert max(seen.values()) <= epochs
        assert all({e for i, e in ((r.doc_id, r.epoch) for r in got) if i == d} == set(range(n)) for d, n in list(seen.items())[:20]) or epochs > 1
    kept = mixing.mix(odd)
    assert kept.columns == odd.columns and kept.count() > 0
    assert mixing.mix(empty).count() == 0
