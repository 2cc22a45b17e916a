"""Main text of web pages by a recurrent block labeller (operator 4).

A page is read as its leaf blocks in order.  Each block is a vector of the hashed steps of its
whole tag path, hashed words and a few measures; a bidirectional LSTM in numpy reads the whole sequence and
says of every block whether it belongs to the article.

It learns from a bounded sample of the pages themselves: structure that plainly marks
content or its surroundings gives the labels, and surroundings of many kinds are worked into
the sampled pages, so that the model knows them where the pages at hand have few.
"""

import collections
import functools
import html
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel.llm.common import bounded_sample

#: Pages to learn from, at most; there is little to learn beyond the structures in use.
MOST_PAGES = 192
LONG = 100_000  # characters of a page that is read by a task, and what the driver gets of it to learn from
SOME_BLOCKS, SOME_TEXT = 300, 500
PATH, WORDS, MEASURES, UNITS = 256, 64, 6, 16
VARIANTS, EPOCHS, GROUP, RATE = 4, 8, 16, 0.02

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<more>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
# Elements of HTML that stand in a line of text, and those that hold nothing.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr input button "
    # formulas, whose text stays
    "math maction annotation annotation-xml menclose merror mfenced mfrac mi mlabeledtr mmultiscripts mn mo mover mpadded "
    "mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none "
    "semantics".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no text of the page; without an end tag only the first two run to the end of the page.
RAW = "script style title textarea iframe template svg".split()
END = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in RAW}
# Elements that show their content where they can't show something else: they leave no step in a path.
CLEAR = set("object canvas audio video".split())
# An open element that ends where one of these starts.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
IN_SELECT = {"option", "optgroup"}
# What marks surroundings for the labels of the sample.
AROUND_TAGS = set("nav header footer aside form menu dialog button fieldset select noscript".split())
AROUND_NAMES = re.compile(
    r"(?:^|[-_ ])(?:ad|ads|advert\w*|sponsor\w*|banner|cookie\w*|consent|notice|alert|sidebar|menu|nav\w*|comment\w*|disqus|repl(?:y|ies)|promo"
    r"|share|social|related|newsletter|subscribe|popup|modal|breadcrumbs?|footer|header|masthead|login|signup|widget)(?:$|[-_ ])"
)
ADVERT_NAMES = re.compile(r"(?:^|[-_ ])(?:ad|ads|advert\w*|sponsor\w*|promo)(?:$|[-_ ])")  # also inside a line of text
# Surroundings that are worked into sampled pages: steps below the body, or below the article.
ASIDE_PATHS = [
    "header p", "header h2", "header.site-header div", "nav.menu li a", "aside p", "aside.sidebar li", "div.sidebar p",
    "div.cookie-notice p", "div.notice p", "div.banner", "div.advert p", "div.ads", "section.related li a", "form label",
    "form p", "div.newsletter form p", "div.comments p", "section.comments div.comment p", "ul.breadcrumb li",
    "footer p", "footer li a", "div.footer p", "div.popup p", "div.social a", "div.share li", "div.login form",
]
INNER_PATHS = ["aside p", "div.ad", "div.comments p", "form label", "div.related li a", "footer p", "div.share", "nav li a",
    "p button", "p span.ad", "p select option", "noscript p",
]
CONTENT_PATHS = [
    "article", "main", "main article", "div.content", "div.post", "section.entry", "div.article-body", "main div",
    "div", "div.container div.text", "div.story", "table tr td", "div.wrapper section",
]
# What an article holds: steps below it.
TEXT_PATHS = [
    "p", "p", "h1", "h2", "h3", "h4", "ul li", "ol li", "ul li p", "ul li ul li", "dl dt", "dl dd", "blockquote", "blockquote p",
    "pre", "table tr td", "table tbody tr td", "table thead tr th", "figure figcaption", "div", "div p", "section p",
    "section h2", "section div p", "header h1", "div ul li", "details p", "address",
]


class Node:
    """An element and all above it: its step, the hashed steps of the path as bits, and what they mark."""

    __slots__ = ("step", "parent", "bits", "around", "inside")

    def __init__(self, step, parent, bits, around, inside):
        self.step, self.parent, self.bits, self.around, self.inside = step, parent, bits, around, inside

    def below(self, step: str) -> "Node":
        bits, tag, named, inside = marks_of(step)
        # the header of an article is part of it, one of the page is not
        around = named or tag in AROUND_TAGS and not (tag == "header" and self.inside)
        return Node(step, self, self.bits | bits, self.around or around, self.inside or inside)

    def path(self) -> tuple[str, ...]:
        steps, node = [], self
        while node.parent is not None:
            steps.append(node.step)
            node = node.parent
        return tuple(reversed(steps))


TOP = Node("", None, 0, False, False)


def node_of(path) -> Node:
    return functools.reduce(Node.below, path, TOP)


class Block:
    __slots__ = ("node", "text", "linked")

    def __init__(self, node, text, linked):
        self.node, self.text, self.linked = node, text, linked

    @property
    def path(self):
        return self.node.path()


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks with text, in order.  A run of text and inline elements is one block.

    Unclosed elements end with the one around them, a paragraph with the next; end tags
    without a start are ignored.  ``br`` is white space.  A button, a choice or an inline
    element named as an advert is a block of its own, and the text around it stays one block.
    The time grows with the length of the page, however deep it nests.
    """
    page = page or ""
    found: list[Block] = []
    stack: list[tuple[str, Node]] = []
    opened: collections.Counter = collections.Counter()
    endless: set[str] = set()
    parts: list[str] = []
    linked = 0
    around = None  # while in a marked inline element: the stack's height, and the text before it

    def emit():
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            found.append(Block(stack[-1][1] if stack else TOP, text, min(linked / len(text), 1.0)))
        parts.clear()
        linked = 0

    def close():
        nonlocal parts, linked, around
        if around is not None:
            height, before, were = around
            rest = "".join(before)
            if rest.strip():
                text = " ".join(html.unescape(rest).split())
                if text:
                    found.append(Block(stack[height - 1][1] if height else TOP, text, min(were / len(text), 1.0)))
            around = (height, [], 0)
        emit()

    def pop():
        nonlocal parts, linked, around
        if around is not None and len(stack) == around[0] + 1:
            emit()
            _, parts, linked = around
            around = None
        opened[stack.pop()[0]] -= 1

    at = 0
    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        if m["text"] is not None:
            parts.append(m["text"])
            if opened["a"]:
                linked += len(m["text"].strip())
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag == "br":
            parts.append(" ")
            continue
        empty = tag in VOID or m["more"].rstrip().endswith("/")
        if tag in END and not m["end"]:
            over = None if empty or tag in endless else END[tag].search(page, at)
            if over:
                at = over.end()
            elif not empty:
                endless.add(tag)
                if tag in ("script", "style"):
                    break
            continue
        names = "" if m["end"] else " ".join(next(filter(None, g), "") for g in NAMED.findall(m["more"])).lower()
        lifted = tag in ("button", "select") or (tag in INLINE and bool(ADVERT_NAMES.search(names)))
        inline = tag in INLINE or tag in ("select", "option", "optgroup")
        if not inline:
            close()
        if m["end"]:
            if opened[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
        elif not empty:
            if not inline:
                while opened["p"] or opened["select"]:
                    pop()
            if tag in ENDED_BY and stack and stack[-1][0] in ENDED_BY[tag]:
                pop()
            if lifted and around is None:
                around = (len(stack), parts, linked)
                parts, linked = [], 0
            elif tag in IN_SELECT:
                parts.append(" ")
            node = stack[-1][1] if stack else TOP
            if tag not in CLEAR and (not inline or lifted or tag == "a"):
                node = node.below(f"{tag}.{'.'.join(names.split())}" if names else tag)
            opened[tag] += 1
            stack.append((tag, node))
    while stack:
        close()
        pop()
    emit()
    return found


@functools.lru_cache(100_000)
def marks_of(step: str) -> tuple[int, str, bool, bool]:
    """Hashed parts of a step as bits, its tag, whether its names mark surroundings, whether it is an article."""
    tag, _, names = step.partition(".")
    bits = 0
    for name in {tag, *step.split(".")[1:]}:
        for part in {name, *re.split(r"[-_]", name)}:
            bits |= 1 << slot("p:" + part, PATH)
    return bits, tag, bool(AROUND_NAMES.search(names.replace(".", " "))), tag in ("article", "main")


@functools.lru_cache(100_000)
def slot(word: str, slots: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % slots


def features(page: list[Block]) -> np.ndarray:
    """A row for each block."""
    out = np.zeros((len(page), PATH + WORDS + MEASURES), np.float32)
    bits = np.frombuffer(b"".join(b.node.bits.to_bytes(PATH // 8, "little") for b in page), np.uint8)
    out[:, :PATH] = np.unpackbits(bits, bitorder="little").reshape(len(page), PATH)
    for i, b in enumerate(page):
        if b.node.step:
            out[i, slot("last:" + b.node.step, PATH)] = 1
        words = b.text.lower().split()
        out[i, PATH : PATH + WORDS] = np.bincount([slot(w, WORDS) for w in words], minlength=WORDS) / len(words)
        end = b.text[-1] in ".!?…\"'”)"
        out[i, PATH + WORDS :] = (
            np.log1p(len(b.text)) / 6, np.log1p(len(words)) / 5, b.linked, end, i / len(page), 1 / (1 + i),
        )
    return out


def plain_label(path: tuple[str, ...], page_has_content: bool) -> int:
    """1 for content, as the structure around a block says."""
    return label_of(node_of(path), page_has_content)


def label_of(node: Node, page_has_content: bool) -> int:
    return int(not node.around and (node.inside or not page_has_content))


def deeper(rng) -> tuple[str, ...]:
    """Steps as articles and their surroundings hold them, nested up to four times, some under names that say nothing."""
    steps: list[str] = []
    for _ in range(rng.integers(1, 5) if rng.random() < 0.3 else 1):
        if rng.random() < 0.2:
            steps.append(f"div.n{rng.integers(10_000)}")
        steps += TEXT_PATHS[rng.integers(len(TEXT_PATHS))].split()
    return tuple(steps)


def sample_sequences(pages: list[list[Block]], rng) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each page as it is, and ``VARIANTS`` times with other surroundings and an article of another length and structure."""
    out = []
    spare = [b.text for p in pages for b in p] or ["text"]
    for page in pages:
        has = any(b.node.inside for b in page)
        labels = [label_of(b.node, has) for b in page]
        out.append((page, labels))
        for _ in range(VARIANTS):
            base = ("html", "body")
            home = base + tuple(CONTENT_PATHS[rng.integers(len(CONTENT_PATHS))].split())
            mixed, marks = [], []

            def add(paths, under, times, mixed=mixed, marks=marks):
                for _ in range(times):
                    path = under + tuple(paths[rng.integers(len(paths))].split())
                    if rng.random() < 0.5:
                        path += deeper(rng)
                    for _ in range(1 + rng.integers(3)):
                        text = spare[rng.integers(len(spare))]
                        text = text if rng.random() < 0.3 else " ".join(text.split()[: 1 + rng.integers(12)])
                        mixed.append(Block(node_of(path), text, float(path[-1] == "a")))
                        marks.append(0)

            add(ASIDE_PATHS, base, rng.integers(4))
            own = [i for i, label in enumerate(labels) if label]
            order = list(range(len(page)))
            keep = rng.random(2) < 0.5  # many pages begin or end with the article
            if own:  # the article's blocks, some left out or said again
                drawn = np.sort(rng.choice(own, int(np.exp(rng.uniform(0, np.log(120))))))
                before, after = range(own[0]), range(own[-1] + 1, len(page))
                order = [*(i for i in before if keep[0]), *drawn.tolist(), *(i for i in after if keep[1])]
            for b, label in ((page[i], labels[i]) for i in order):
                if label:
                    kind = deeper(rng) if rng.random() < 0.6 else (b.node.step or "p",)
                    kind = kind if home[-1] in ("article", "main") else tuple(k for k in kind if k != "header")
                    text = b.text if rng.random() < 0.7 else " ".join(b.text.split()[: 1 + rng.integers(6)])
                    mixed.append(Block(node_of(home + tuple(kind)), text, b.linked))
                else:
                    mixed.append(b)
                marks.append(label)
                if label and rng.random() < 0.1:
                    add(INNER_PATHS, home, 1)
            add(ASIDE_PATHS, base, rng.integers(4))
            out.append((mixed, marks))
    return [(without_some_words(features(p), rng), np.array(m, np.float32)) for p, m in out if p]


def without_some_words(rows: np.ndarray, rng) -> np.ndarray:
    """Words and measures of half the blocks are blanked, so that the model doesn't learn the sample's texts by heart."""
    rows[:, PATH:] *= rng.random((len(rows), 1)) < 0.5
    return rows


class Lstm:
    """A bidirectional LSTM with one output for each step; gates in the order i, f, o, g."""

    def __init__(self, rng):
        size = PATH + WORDS + MEASURES
        shape = {"x": (size, 4 * UNITS), "h": (UNITS, 4 * UNITS), "b": (4 * UNITS,)}
        self.w = {}
        for way in "fb":
            for name, dims in shape.items():
                scale = 0 if name == "b" else (0.3 if name == "x" else 1 / np.sqrt(UNITS))
                self.w[way + name] = (rng.standard_normal(dims) * scale).astype(np.float32)
            self.w[way + "b"][UNITS : 2 * UNITS] = 1
        self.w["out"] = (rng.standard_normal((2 * UNITS, 1)) * 0.3).astype(np.float32)
        self.w["bias"] = np.zeros(1, np.float32)

    def _run(self, way, x, mask):
        """Hidden states (step, row, unit) and what the backward pass needs."""
        steps, rows = mask.shape
        h = c = np.zeros((rows, UNITS), np.float32)
        given = x.reshape(-1, x.shape[-1]) @ self.w[way + "x"] + self.w[way + "b"]
        given = given.reshape(steps, rows, -1)
        out, kept = np.zeros((steps, rows, UNITS), np.float32), [None] * steps
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = given[t] + h @ self.w[way + "h"]
            s = 1 / (1 + np.exp(-np.clip(z[:, : 3 * UNITS], -30, 30)))
            i, f, o = s[:, :UNITS], s[:, UNITS : 2 * UNITS], s[:, 2 * UNITS :]
            g = np.tanh(z[:, 3 * UNITS :])
            m = mask[t][:, None]
            new = f * c + i * g
            kept[t] = (h, c, i, f, o, g, new)
            h, c = np.where(m, o * np.tanh(new), h), np.where(m, new, c)
            out[t] = h
        return out, kept

    def chances(self, x, mask):
        states = np.concatenate([self._run("f", x, mask)[0], self._run("b", x, mask)[0]], axis=2)
        return 1 / (1 + np.exp(-np.clip(states @ self.w["out"] + self.w["bias"], -30, 30)))[:, :, 0]

    def slopes(self, x, mask, y):
        """Gradients of the mean log loss, by backpropagation through time."""
        (hf, kf), (hb, kb) = self._run("f", x, mask), self._run("b", x, mask)
        states = np.concatenate([hf, hb], axis=2)
        p = 1 / (1 + np.exp(-np.clip(states @ self.w["out"] + self.w["bias"], -30, 30)))[:, :, 0]
        d = ((p - y) * mask / max(mask.sum(), 1))[:, :, None].astype(np.float32)
        grad = {"out": np.einsum("trk,tro->ko", states, d), "bias": d.sum(axis=(0, 1))}
        back = d * self.w["out"][:, 0]
        for way, kept, dh_all in (("f", kf, back[:, :, :UNITS]), ("b", kb, back[:, :, UNITS:])):
            steps, rows = mask.shape
            dz_all = np.zeros((steps, rows, 4 * UNITS), np.float32)
            grad[way + "h"] = np.zeros_like(self.w[way + "h"])
            dh = dc = np.zeros((rows, UNITS), np.float32)
            for t in range(steps - 1, -1, -1) if way == "f" else range(steps):
                h, c, i, f, o, g, new = kept[t]
                m = mask[t][:, None]
                dh = dh + dh_all[t]
                tc = np.tanh(new)
                dnew = dh * o * (1 - tc * tc) + dc
                dz = np.concatenate(
                    [dnew * g * i * (1 - i), dnew * c * f * (1 - f), dh * tc * o * (1 - o), dnew * i * (1 - g * g)], axis=1
                )
                dz_all[t] = dz = np.where(m, dz, 0)
                grad[way + "h"] += h.T @ dz
                dh, dc = np.where(m, dz @ self.w[way + "h"].T, dh), np.where(m, dnew * f, dc)
            flat = dz_all.reshape(-1, 4 * UNITS)
            grad[way + "x"] = x.reshape(-1, x.shape[-1]).T @ flat
            grad[way + "b"] = flat.sum(axis=0)
        return grad

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block is content, for pages of any length, like lengths together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        while order:
            some = []
            while order and len(some) < 64 and (not some or (len(some) + 1) * len(pages[order[0]]) <= 8192):
                some.append(order.pop(0))
            x, mask, _ = padded([(pages[i], None) for i in some])
            p = self.chances(x, mask)
            for k, i in enumerate(some):
                out[i] = p[: len(pages[i]), k] >= 0.5
        return out


def padded(rows):
    steps = max(len(x) for x, _ in rows)
    x = np.zeros((steps, len(rows), PATH + WORDS + MEASURES), np.float32)
    mask, y = np.zeros((steps, len(rows)), bool), np.zeros((steps, len(rows)), np.float32)
    for k, (one, labels) in enumerate(rows):
        x[: len(one), k], mask[: len(one), k] = one, True
        if labels is not None:
            y[: len(one), k] = labels
    return x, mask, y


def train(pages: list[list[Block]], seed: int = 1) -> Lstm:
    """Fit by Adam on the sampled pages and their variants."""
    rng = np.random.default_rng(seed)
    model = Lstm(rng)
    data = sample_sequences(pages, rng)
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    n = 0
    for _ in range(EPOCHS):
        order = sorted(range(len(data)), key=lambda i: (len(data[i][0]) // 8, rng.random()))
        groups = [order[i : i + GROUP] for i in range(0, len(order), GROUP)]
        for at in rng.permutation(len(groups)):
            n += 1
            for k, g in model.slopes(*padded([data[i] for i in groups[at]])).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model.w[k] -= RATE * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.999**n)) + 1e-8)
    return model


def learn(pages: DataFrame, most: int = MOST_PAGES) -> Lstm:
    """Fit on a bounded sample: the ``most`` pages of smallest hash; long ones where the others are too few."""
    rows = pages.where("trim(html) <> ''").select("page_id", F.col("html").cast("string").alias("html"))
    short = rows.where(F.length("html") < LONG)
    picked = bounded_sample(short, most, short.count(), "page_id", "html").collect()
    found = [b for b in (blocks(r.html) for r in picked) if b]
    if len(found) < most:
        found += long_pages(rows.where(F.length("html") >= LONG), most)[: most - len(found)]
    return train(found)


def long_pages(rows: DataFrame, most: int) -> list[list[Block]]:
    """Blocks of up to ``most`` long pages, read by the tasks: of each page some from all over, with the start of their text."""
    rows = rows.withColumn("place", F.xxhash64("page_id", "html"))
    places = rows.select("place").distinct()
    picked = [r.place for r in bounded_sample(places, most, places.count(), "place").collect()]

    def read(batches):
        for batch in batches:
            for place, page in zip(batch.column("place").to_pylist(), batch.column("html")):
                found = blocks(page.as_py())
                at = np.unique(np.linspace(0, len(found) - 1, SOME_BLOCKS).astype(int)) if found else []
                some = [found[i] for i in at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([place]), pa.array([[b.node.step for b in some]], pa.list_(pa.string())),
                     pa.array([[b.node.bits.to_bytes(PATH // 8, "little") for b in some]], pa.list_(pa.binary())),
                     pa.array([[b.node.around for b in some]], pa.list_(pa.bool_())),
                     pa.array([[b.node.inside for b in some]], pa.list_(pa.bool_())),
                     pa.array([[b.text[:SOME_TEXT] for b in some]], pa.list_(pa.string())),
                     pa.array([[float(b.linked) for b in some]], pa.list_(pa.float64()))], ["place", "steps", "bits", "around", "inside", "texts", "linked"],
                )

    shape = "place long, steps array<string>, bits array<binary>, around array<boolean>, inside array<boolean>, texts array<string>, linked array<double>"
    found = rows.where(F.col("place").isin(picked)).select("place", "html").mapInArrow(read, shape)
    pages = [r for r in found.dropDuplicates(["place"]).orderBy("place").collect() if r.texts]
    return [
        [Block(Node(s, TOP, int.from_bytes(b, "little"), a, i), t, x)
         for s, b, a, i, t, x in zip(r.steps, r.bits, r.around, r.inside, r.texts, r.linked)]
        for r in pages
    ]


def extract(pages: DataFrame, model: Lstm) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.

    The text joins the blocks labelled as content, in order, by line ends.  A null or empty
    page, and one without content, has an empty text and 0 characters.  Repeated rows come as
    often; null ids and urls stay null; other columns play no part.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string").alias("html")
    )

    def read(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                found = [blocks(h) for h in batch.column("html").to_pylist()]
                marks = model.label([features(b) for b in found])
                texts = ["\n".join(b.text for b, m in zip(page, mark) if m) for page, mark in zip(found, marks)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"],
                )

    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long")
