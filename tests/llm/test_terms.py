"""Phrases, source divergence and token counts against brute force."""

import collections
import itertools
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from laurel.llm import collocations, divergence, token_counts
from laurel.llm.textscan import KeyFilter, Words, byte_kinds

SHAPE = "doc_id long, text string, lang string, source string, n long, phrase string, term string, shard int"
ASCII_LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def frame(spark, rows):
    return spark.createDataFrame([tuple(r) + (9, "x", "x", 9) for r in rows], SHAPE)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "dé", "Éa", "z", "ß", "longer-word", "12", "日本"]
    weights = [30, 20, 10, 8, 5, 5, 3, 3, 2, 1]
    out = [
        (1, None, "en", "s1"), (2, "", "en", "s1"), (3, " . , ", None, "s2"), (None, "alpha beta gamma", None, None),
        (4, "w" * 5000 + " alpha\tbeta. " + "w" * 5000, "en", "s3"), (4, "alpha beta", "en", "s3"), (5, "12 34", "xx", "s9"),
    ]
    for i in range(60):
        parts = rng.choices(words, weights, k=rng.randint(0, 40))
        text = "".join(w + rng.choice([" ", "  ", "\t", ". ", "\n", " ", " "]) for w in parts)
        out.append((10 + i, text, rng.choice(["en", "en", "fr", None]), rng.choice(["s1", "s1", "s2", "s3", None])))
    return out + [(500 + i, "alpha beta gamma z z z z z z alpha beta gamma", "en", "s1") for i in range(8)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(5).cache()


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- phrases ------------------------------------------------------------------------

def brute_counts(rows, longest):
    counts, totals = collections.Counter(), collections.Counter()
    for _, text, lang, _ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang or "und", " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    return counts, totals


def brute_collocations(rows, threshold, top, share=100, longest=5):
    counts, totals = brute_counts(rows, longest)
    found = collections.defaultdict(list)
    candidates = {k: a for k, a in counts.items() if a >= threshold and " " in k[1]}
    for (lang, phrase), a in candidates.items():
        if any(
            l == lang and len(other) > len(phrase) and f" {phrase} " in f" {other} " and 100 * b >= share * a
            for (l, other), b in candidates.items()
        ):
            continue
        words, n, cuts = phrase.split(" "), totals[lang], []
        for k in range(1, len(words)):
            l, r = counts[lang, " ".join(words[:k])], counts[lang, " ".join(words[k:])]
            cuts.append((1000 * a * n // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        found[lang].append((-score, -a, phrase.encode(), phrase, l, r, n))
    return sorted(
        (
            (lang, i + 1, phrase, -a, l, r, n, -score)
            for lang, best in found.items() for i, (score, a, _, phrase, l, r, n) in enumerate(sorted(best)[:top])
        ),
        key=repr,
    )


@pytest.mark.parametrize("threshold,share,shards", [(4, 100, 3), (9, 80, 2), (1, 100, 1)])
def test_collocations_against_brute_force(spark, docs, rows, threshold, share, shards):
    some = rows if threshold > 1 else rows[:12]
    found = collocations.collocations(docs if threshold > 1 else frame(spark, some), threshold, top=40, share=share, shards=shards)
    assert collected(found) == brute_collocations(some, threshold, 40, share)


def test_counts_with_a_filter_that_is_full(docs, rows, monkeypatch):
    """What a crowded filter lets through in vain changes no count."""
    monkeypatch.setattr(KeyFilter, "SIZE", 2)
    counts, totals = brute_counts(rows, 4)
    expected = [(l, p, n) for (l, p), n in counts.items() if n >= 5] + [(l, "", n) for l, n in totals.items() if n]
    assert collected(collocations.phrase_counts(docs, 5, 4, 2)) == sorted(expected, key=repr)


def test_phrase_tables_are_dropped(spark, docs):
    collocations.phrase_counts(docs, 50).count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("phrase_counts")]


def test_large_products_stay_exact(spark, monkeypatch):
    big = 3_000_000_000_000
    counted = spark.createDataFrame(
        [("en", "", 7 * big), ("en", "a", 2 * big - 1), ("en", "b", big + 7), ("en", "a b", big)], "lang string, phrase string, n long"
    )
    monkeypatch.setattr(collocations, "phrase_counts", lambda *a: counted)
    [row] = collocations.collocations(None).collect()
    assert row.score == 1000 * big * 7 * big // ((2 * big - 1) * (big + 7))


# --- divergence ---------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_audit(rows, least, top):
    occurrences, holding, groups = collections.Counter(), collections.Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(ASCII_LOW))
        occurrences.update((lang, source, t) for t in terms)
        holding.update((lang, t) for t in set(terms))
    out = []
    for lang, source in groups:
        kept = [t for (l, t), n in holding.items() if l == lang and n >= least]
        sources = [s for l, s in groups if l == lang]
        total = {s: sum(occurrences[lang, s, t] for t in kept) for s in sources}
        share = lambda n, all_: 1 + 1_000_000_000 * (n + 1) // (all_ + len(kept))
        gap = lambda p, q: (p - q) * (p - q) // q
        own = {t: share(occurrences[lang, source, t], total[source]) for t in kept}
        pair = [
            (-sum(gap(own[t], share(occurrences[lang, s, t], total[s])) for t in kept), s) for s in sources if s != source
        ]
        usual = {t: share(sum(occurrences[lang, s, t] for s in sources), sum(total.values())) for t in kept}
        term = [(-gap(own[t], usual[t]), t) for t in kept if occurrences[lang, source, t] and own[t] > usual[t]]
        for part, items in (("pair", pair), ("term", sorted(term, key=lambda x: (x[0], x[1].encode()))[:top])):
            ordered = sorted(items, key=lambda x: (x[0], x[1].encode()))
            out += [(lang, source, part, item, -value, i + 1) for i, (value, item) in enumerate(ordered)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("least,width", [(3, 2), (2, 1), (9, 3), (1000, 2)])
def test_audit_against_brute_force(docs, rows, least, width):
    assert collected(divergence.audit(docs, least, 5, width)) == brute_audit(rows, least, 5)


def test_audit_with_a_full_filter_and_small_blocks(docs, rows, monkeypatch):
    monkeypatch.setattr(KeyFilter, "SIZE", 2)
    monkeypatch.setattr(divergence, "PAIRS", 3)
    assert collected(divergence.audit(docs, 3, 5)) == brute_audit(rows, 3, 5)


def test_audit_with_small_slices_and_pools(docs, rows, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 40)
    monkeypatch.setattr(divergence, "POOL", 3)
    assert collected(divergence.audit(docs, 3, 2)) == brute_audit(rows, 3, 2)


def test_a_task_sums_equal_rows_of_its_slices(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 10)
    batch = pa.RecordBatch.from_pydict({"text": ["alpha beta alpha"] * 9 + ["beta"], "lang": ["en"] * 10})
    [found] = divergence._refine(8, 0, None)([batch])
    assert sorted(zip(found["key"].to_pylist(), found["docs"].to_pylist())) == [(b"alpha", 9), (b"beta", 10)]


def test_contenders_keep_the_first_of_each_group():
    rng = np.random.default_rng(6)
    group, value = rng.integers(0, 5, 3000), rng.integers(0, 300, 3000)
    batches = [
        pa.RecordBatch.from_pydict({"group": group[i : i + 250], "value": value[i : i + 250], "item": [str(j) for j in range(i, i + 250)]})
        for i in range(0, 3000, 250)
    ]
    sent = [j for b in divergence._contenders(7)(batches) for j in map(int, b["item"].to_pylist())]
    assert len(sent) == len(set(sent)) < 1500
    for g in range(5):
        bar = np.sort(value[group == g])[-7]
        assert set(np.flatnonzero((group == g) & (value >= bar))) <= set(sent)


def test_long_kept_terms(spark):
    long_one = "é" * 300 + "a" * 1000
    found = divergence.kept_terms(frame(spark, [(i, f"{long_one} {long_one}b{i} x{i}y", "en", "s") for i in range(3)]))
    assert collected(found) == [("en", "x", 3), ("en", "y", 3), ("en", long_one, 3), ("en", long_one + "b", 3)]


# --- token counts -------------------------------------------------------------------

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


def test_every_proven_word_is_one_token(whole):
    proven = sorted(token_counts.proven_words(PATH))
    assert len(proven) > 20_000
    encoded = whole.encode_batch(proven, add_special_tokens=False)
    assert [w for w, e in zip(proven, encoded) if len(e.ids) != 1] == []


def test_token_counts_against_the_library(spark, whole):
    rng = random.Random(3)
    odd = ["<|endoftext|>", "<|startoftext|>x", "<|end", "don't", "İSTANBUL", "Σίσυφος", "é", "ﬁ", "a b", " ", "日本語",
           "🙂🙂", "1234", "x" * 3000, "\t", "\r\n", "'LL", "½", "ª", "\x00", "\x1c", "ÀÉ", "the", "Quality", "ſ", "K", "--==--"]
    texts = [None, "", " ", "\n\n"] + odd
    texts += ["".join(rng.choice(odd) + rng.choice(["", " ", "\n", "  "]) for _ in range(rng.randint(1, 30))) for _ in range(400)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 255), rng.randint(0x100, 0x2FFF)])) for _ in range(40)) for _ in range(300)]
    texts += ["the cat sat " * 800]
    found = token_counts.count_tokens(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, "a b", None, None)]))
    got = {r.doc_id: r for r in found.collect()}
    assert got.pop(None).n_tokens == 2
    for i, text in enumerate(texts):
        n = len(whole.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), n, n > 2048), repr(text)


# --- empty tables, helpers -------------------------------------------------------------

def test_empty_tables(spark):
    none = frame(spark, [])
    assert collocations.collocations(none).count() == 0
    assert divergence.audit(none).count() == 0
    assert token_counts.count_tokens(none).count() == 0


def test_words_and_their_hashes():
    texts = ["Ab  c", None, "", "c", "ab", " é.c ", "x" * 5000 + " " + "x" * 5000, "12345678 123456789"]
    words = Words(pa.array(["skipped", *texts])[1:], byte_kinds(b" ", b"."))
    data = words.data.tobytes()
    found = [data[s : s + n].decode() for s, n in zip(words.starts, words.lengths)]
    assert found == ["ab", "c", "c", "ab", "é", "c", "x" * 5000, "x" * 5000, "12345678", "123456789"]
    assert words.doc.tolist() == [0, 0, 3, 4, 5, 5, 6, 6, 7, 7]
    keys = words.hashes(1).tolist()
    for i, j in itertools.combinations(range(len(found)), 2):
        assert (keys[i] == keys[j]) == (found[i] == found[j])
    assert len(set(words.select(np.array([8, 9])).hashes(1, 8).tolist())) == 1
    assert words.phrases(np.array([0, 8]), 2).to_pylist() == ["ab c", "12345678 123456789"]
