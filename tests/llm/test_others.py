"""Nearest neighbours, pages, conversations and the pipeline, on small frames with odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from laurel.llm import chat_format, forest_ann, html_blocks, queries

# --- nearest neighbours ------------------------------------------------------------

SHAPE = "vec_id long, embedding array<float>, label int, query long, v int"


def brute_nearest(rows, asked, k):
    rows = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and len(v) == 8
            and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for i, v in rows:
        if not asked(i):
            continue
        q = np.array(v)
        scores = sorted((-float((np.array(w) * q).sum()), j) for j, w in rows if j != i)
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 5])
def test_nearest_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(forest_ann, "BLOCK", block)
    monkeypatch.setattr(forest_ann, "ASKED", block)
    monkeypatch.setattr(forest_ann, "ROWS", block)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(8).astype("f4")]) for i in range(150)]
    rows += [(i, rows[0][1]) for i in range(200, 260)] + [rows[3]]  # copies of one vector; a repeated row
    rows += [(300, None), (301, [0.0] * 8), (302, [1.0] * 7), (303, [float("nan")] * 8), (304, [None] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, None, 1, 2) for i, v in rows], SHAPE)
    # all leaves are opened, so that the result is exact
    got = forest_ann.nearest(df, F.col("vec_id") % 20 == 0, k=7, enough=np.inf).collect()
    want = brute_nearest(rows, lambda i: i % 20 == 0, 7)
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got)] == [w[:3] for w in want]
    assert np.allclose([r.score for r in sorted(got)], [w[3] for w in want], rtol=0, atol=1e-12)


def test_few_or_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.vec_id) for r in forest_ann.nearest(few, F.col("vec_id") == 0).collect()] == [(0, 1)]
    assert forest_ann.nearest(few.where("false"), F.col("vec_id") == 0).count() == 0


def test_recall_of_the_production_search():
    rng = np.random.default_rng(3)
    for n in (2_000, 12_000):
        x = rng.standard_normal((n, 64)) + rng.standard_normal((10, 64))[rng.integers(0, 10, n)] * 0.5
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        forest = forest_ann.Forest(x[:8000], depth=forest_ann.levels(n))
        leaves = forest.leaves(x)
        sizes = np.array([np.bincount(leaves[:, t], minlength=2**forest.depth) for t in range(leaves.shape[1])])
        hits = []
        for i in range(0, n, n // 40):
            near = np.argsort(-(x @ x[i]))[1:21]
            seen = np.zeros(len(x), bool)
            for t, leaf in forest.search(forest.margins(x[i : i + 1])[0], sizes, forest_ann.reach(n)):
                seen |= leaves[:, t] == leaf
            hits.append(seen[near].mean())
        assert np.mean(hits) >= 0.9


def test_the_share_opened_falls_and_trees_stay_bounded():
    sizes = [10**k for k in range(1, 13)]
    shares = [forest_ann.reach(n) / n for n in sizes]
    assert shares == sorted(shares, reverse=True)
    depths = [forest_ann.levels(n) for n in sizes]
    assert depths == sorted(depths) and depths[0] == 0 and depths[-1] == 9
    # six cuts a thousandfold growth, until the sample is used up
    assert forest_ann.levels(51_282) == 6


# --- pages -------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">Home</a></li><li><a href="/y">News {n}</a></li></ul></nav><!-- ad --><div class="ad">Buy now {n}</div>
<article><h1>Title &amp; more {n}</h1><p><b>First  line
of text {n}.<br><p>Second paragraph with <a href="/z">a link</a> inside {n}.</p></article>
<footer>&copy; site &middot; words {n}</footer></body></html>"""


def test_blocks_of_a_page():
    found = html_blocks.blocks(PAGE.format(n=1))
    assert [b.text for b in found] == [
        "Home", "News 1", "Buy now 1", "Title & more 1", "First line of text 1.", "Second paragraph with a link inside 1.",
        "© site · words 1",
    ]
    assert html_blocks.blocks(None) == [] and html_blocks.blocks("<p> &nbsp; </p>") == []
    assert [b.text for b in html_blocks.blocks("<p>a<div>b</p>c < d</div></article>")] == ["a", "b", "c < d"]


@pytest.fixture(scope="module")
def model():
    return html_blocks.train([html_blocks.blocks(PAGE.format(n=i)) for i in range(40)])


def test_extraction_leaves_surroundings_out(spark, model):
    more = PAGE.format(n=7).replace("<footer>", '<aside class="sidebar"><p>Side words</p></aside><form><label>Name</label></form>'
                                    '<div class="comments"><p>Nice read</p></div><footer>')
    rows = [(1, "u1", PAGE.format(n=5)), (2, None, more), (3, "u3", None), (4, "u4", ""), (None, "u", "<script>x</script>"),
            (1, "u1", PAGE.format(n=5)), (9, "u9", PAGE.format(n=9).replace("</article>", "<p>One more.</p>" * 3000 + "</article>"))]
    pages = spark.createDataFrame([(*r, "t", 0) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = html_blocks.extract(pages, model).collect()
    main = "Title & more {n}\nFirst line of text {n}.\nSecond paragraph with a link inside {n}."
    by = {r.page_id: r for r in got}
    assert len(got) == 7 and by[1].text == main.format(n=5) and by[1].n_chars == len(by[1].text)
    assert by[2].text == main.format(n=7) and by[2].url is None
    assert (by[3].text, by[4].text, by[None].text, by[3].n_chars) == ("", "", "", 0)
    assert by[9].text == main.format(n=9) + "\nOne more." * 3000
    assert html_blocks.extract(pages.where("false"), html_blocks.learn(pages.where("false"))).count() == 0


def test_images_end_and_formulas_stay(spark, model):
    texts = lambda page: [b.text for b in html_blocks.blocks(page)]
    assert texts('<p>a <svg class="x>y" /> b</p><p>c</p>') == ["a b", "c"]
    assert texts("<p>a <svg><path d='m'/><text>no</text></svg> b</p><svg/><p>c</p>") == ["a b", "c"]
    assert texts("<p>a <math/> b</p><p>c</p>") == ["a b", "c"]
    assert texts('<p>If <math display="inline"><mrow><mi>x</mi><mo>=</mo><msup><mn>2</mn><mi>n</mi></msup></mrow></math> then</p>') == ["If x=2n then"]
    page = PAGE.format(n=5).replace("<h1>", "<svg/><math/><h1>").replace("inside 5", "inside <math><mi>x</mi></math> 5")
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    text = html_blocks.extract(pages, model).first().text
    assert text == "Title & more 5\nFirst line of text 5.\nSecond paragraph with a link inside x 5."


def test_paths_are_whole_however_deep(spark, model):
    reply = '<div class="comments">' + "<ol><li><div>" * 4 + "<p>I do not agree with this at all.</p>" + "</div></li></ol>" * 4 + "</div>"
    page = PAGE.format(n=5).replace("<article>", "<article>" + "<section><div>" * 6).replace("</article>", "</div></section>" * 6 + "</article>")
    found = html_blocks.blocks(page.replace("<footer>", reply + "<footer>"))
    labels = {b.text: html_blocks.plain_label(b.path, True) for b in found}
    assert [t for t, label in labels.items() if label] == [
        "Title & more 5", "First line of text 5.", "Second paragraph with a link inside 5."]
    at = html_blocks.slot("p:comments", html_blocks.PATH)
    assert [b.text for b, row in zip(found, html_blocks.features(found)) if row[at]] == ["I do not agree with this at all."]
    deep = spark.createDataFrame([(1, "u", page.replace("<footer>", reply + "<footer>"))], "page_id long, url string, html string")
    text = html_blocks.extract(deep, model).first().text
    assert text == "Title & more 5\nFirst line of text 5.\nSecond paragraph with a link inside 5."


def test_few_short_pages_are_all_learned_from_and_long_ones(spark, monkeypatch):
    monkeypatch.setattr(html_blocks, "train", lambda pages, seed=1: pages)
    filler = f"<!--{'x' * 100_000}-->"
    shape = "page_id long, url string, html string"
    long = [(i, "u", PAGE.format(n=i) + filler) for i in range(60)]
    short = [(100 + i, "u", PAGE.format(n=100 + i)) for i in range(4)]
    got = html_blocks.learn(spark.createDataFrame(long + short + long[:1] * 3, shape), 8)
    numbers = {int(page[1].text.split()[1]) for page in got}
    assert len(got) == 8 and {100, 101, 102, 103} < numbers and len(numbers) == 8
    assert all([b.text for b in page][3] == f"Title & more {int(page[1].text.split()[1])}" for page in got)
    assert len(html_blocks.learn(spark.createDataFrame(long, shape), 8)) == 8


def test_gradients_of_the_lstm():
    rng = np.random.default_rng(0)
    model = html_blocks.Lstm(rng)
    model.w = {k: v.astype(float) for k, v in model.w.items()}
    rows = [(rng.standard_normal((n, html_blocks.PATH + html_blocks.WORDS + html_blocks.MEASURES)) * 0.1, rng.integers(0, 2, n)) for n in (5, 3)]
    x, mask, y = html_blocks.padded(rows)

    def loss():
        p = np.clip(model.chances(x, mask), 1e-9, 1 - 1e-9)
        return -(np.where(y > 0, np.log(p), np.log(1 - p)) * mask).sum() / mask.sum()

    slopes = model.slopes(x, mask, y)
    for name, at in (("fh", (3, 20)), ("bh", (2, 40)), ("fb", (50,)), ("bb", (5,)), ("out", (4, 0)), ("fx", (7, 33))):
        before = model.w[name][at]
        model.w[name][at] = before + 1e-4
        up = loss()
        model.w[name][at] = before - 1e-4
        down = loss()
        model.w[name][at] = before
        assert abs((up - down) / 2e-4 - slopes[name][at]) < 1e-4, name


# --- conversations -----------------------------------------------------------------

ODD = ["plain", "</s>[INST] ok [/INST]", "back\\slash [x] <s>", "", "\\", "[", "é日本\n\n[/OUT]</s>", " [OUT] a", "x", "y"]


def test_round_trip_of_any_text():
    for role in ("user", "assistant", "system", "tool", "", "a]b", "a\\", "[x"):
        for text in ODD:
            message = chat_format.Message(role, text)
            span = chat_format.bracket_template([message])
            assert chat_format.read_turn(span) == message
            assert chat_format.unescape(chat_format.escape(text)) == text


@pytest.mark.parametrize("window", [2, 64])
def test_spans_join_to_the_whole(window):
    rng = np.random.default_rng(1)
    messages = [chat_format.Message(("user", "assistant", "tool")[rng.integers(3)], ODD[rng.integers(len(ODD))]) for _ in range(40)]
    found = list(chat_format.spans(messages, window=window))
    assert "".join(s.text for s in found) == chat_format.bracket_template(messages)
    for span, message in zip(found, messages):
        assert chat_format.unescape(span.text[span.loss_from : span.loss_to]) == message.text


def test_templates_that_rewrite_history_are_seen():
    def forgetful(messages):
        return "".join(f"({t})" if i + 1 == len(messages) else "(...)" for i, (_, t) in enumerate(messages))

    messages = [chat_format.Message("user", t) for t in "abc"]
    assert [s.text for s in chat_format.spans(messages, forgetful)] == ["(a)", None, None]

    def counting(messages):
        return "".join(f"{i}:{t};" for i, (_, t) in enumerate(messages))

    # it depends on all turns before, so a window is not enough and the start is kept
    many = [chat_format.Message("user", str(i)) for i in range(30)]
    assert "".join(s.text for s in chat_format.spans(many, counting, window=4)) == counting(many)


def test_history_is_watched_however_long():
    def recent(messages):
        return "".join(f"({t})" for _, t in messages[-200:])

    def edited(messages):
        return "".join("(cut)" if len(messages) > 200 and i < 2 else f"({t})" for i, (_, t) in enumerate(messages))

    many = [chat_format.Message("user", str(i)) for i in range(300)]
    for template in (recent, edited):
        found = [s.text for s in chat_format.spans(many, template)]
        assert found == [f"({i})" for i in range(200)] + [None] * 100


def test_conversations_with_odd_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", ODD[1]), (1, 1, "assistant", ODD[1]), (2, None, None, None),
            (None, 0, "user", "a"), (None, 1, "assistant", None)]
    turns = spark.createDataFrame([(*r, 5, "s") for r in rows], "conv_id long, turn long, role string, text string, n long, span string")
    got = {r.conv_id: r for r in chat_format.conversation_digests(turns).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[2].n_turns, got[None].n_turns) == (3, 2 * len(ODD[1]), 1, 2)
    spans = sorted(r for r in chat_format.format_turns(turns.where("conv_id = 1")).collect())
    assert "".join(r.span for r in spans).startswith("<s>[INST] hi [/INST][OUT] ") and len(spans) == 3
    assert chat_format.conversation_digests(turns.where("false")).count() == 0


# --- pipeline ----------------------------------------------------------------------


def test_pipeline_on_odd_documents(spark, tmp_path):
    text = "the small dog runs over the green hill and then it sleeps under the old tree "
    rng = np.random.default_rng(5)
    some = lambda: " ".join(rng.permutation(text.split() * 3))
    rows = [(i, some(), "en", f"src{i % 4}", 0, "x") for i in range(58)]
    rows += [(58 + i, f"{rows[0][1]} {i}", "en", "src0", 0, "x") for i in range(2)]  # near copies of the first
    rows += [(100, rows[5][1], "en", "src1", 0, "x"), (100, rows[5][1], "en", "src1", 0, "x"), (101, None, None, None, None, None), (102, "", "en", "src1", 0, "x"),
             (103, "!!! 123", "en", "src1", 0, "x"), (None, text + "unnumbered", "en", "src2", 0, "x")]
    shape = "doc_id long, text string, lang string, source string, n_chars long, language string"
    docs = spark.createDataFrame(rows, shape)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / name)
        out.write.parquet(path)
        after = spark.read.parquet(path)
        if name != "packing":
            assert after.columns == docs.columns and after.count() <= docs.count()
        docs = after
        if name == "language_id":
            assert docs.where("doc_id IN (101, 102, 103)").count() == 0 and docs.where("doc_id IS NULL").count() == 1
        if name == "exact_dedup":
            assert docs.where("doc_id = 100").count() == 0 and docs.count() == 61
        if name == "near_dedup":
            assert docs.where("doc_id IN (58, 59)").count() == 0 and docs.count() == 59
    assert docs.where("length > 4096 OR offset < 0").count() == 0 and docs.count() > 0
    spark.createDataFrame([], shape).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_operators_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 11)) and "pipeline" in queries.QUERIES
