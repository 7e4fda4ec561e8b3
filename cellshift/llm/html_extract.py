"""HTML extraction by a recurrent block labeller.

A page is cut into leaf blocks: the text between block-level tags, with the path
of open tags, their class and id words, and the share of link text.  A
bidirectional LSTM in numpy reads the blocks of a page in order, each as a hashed
tag-path vector beside a hashed word vector, so every block is classified with
the whole page in view.  The main text is the blocks it calls content.

The labeller is trained here, on a bounded sample of pages that label themselves
(blocks inside article or main, outside of menus, forms and the like) and on
pages put together from templates with the same words, which wrap content and
boilerplate in many other ways.
"""

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements of HTML by the way they break text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = ("script", "style", "noscript", "template", "title", "textarea", "svg", "iframe", "object")
#: Elements whose text is never the article's.
OUTSIDE_TAGS = frozenset("nav footer aside form menu dialog select button head".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb comment comments cookie cookies disqus footer "
    "header menu nav navbar newsletter notice popup promo related replies reply responses share "
    "sidebar signup social sponsor sponsored subscribe widget".split()
)
INSIDE_TAGS = frozenset("article main".split())

PATH_SIZE, WORD_SIZE, OTHER_SIZE = 96, 64, 8
INPUT = PATH_SIZE + WORD_SIZE + OTHER_SIZE
UNITS = 12
SAMPLE_PAGES = 192
TEMPLATE_PAGES = 480
EPOCHS = 6
BATCH = 48
RATE = 0.01
LONGEST = 256  # blocks a training page is cut to; reading is never cut
WORDS_KEPT = 200_000  # cached word hashes of a worker
PLACES_KEPT = 20_000  # cached paths of a worker, between pages
TEMPLATE_WORDS = 50_000  # words of the page sample that fill the templates, chosen by a hash

_piece = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<svg(?=[\s/>])[^>\"']*+(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*+)*+(?<=/)>"  # empty, unlike other silent tags written so
    rf"|<({'|'.join(SILENT_TAGS)})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>",
    re.S | re.I,
)
_named = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_simple = re.compile(r"[a-z0-9]+")


#: An element of the key ends at once an open one of these, whose end tag may be left out.
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tr": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "option": {"option"},
}


class Place:
    """An open element: its tag and class words, and what its path adds up to.

    A path is a link to the place outside and what that one summed up, so an element costs the
    same however deep it lies.
    """

    __slots__ = ("outer", "words", "inside", "outside", "total", "_row")

    def __init__(self, outer: "Place | None", words: tuple[str, ...]):
        self.outer, self.words, self._row = outer, words, None
        self.inside = bool(outer and outer.inside) or not INSIDE_TAGS.isdisjoint(words)
        self.outside = bool(outer and outer.outside) or any(
            w in OUTSIDE_TAGS or w[1:] in OUTSIDE_WORDS for w in words
        )
        self.total = outer.total.copy() if outer else np.zeros(PATH_SIZE + 2, dtype=np.float32)
        for word in words:
            self.total[_path_slot(word)] += 0.5

    @property
    def row(self) -> np.ndarray:
        """Hashed words of the path, the nearest four heavier, and two flags."""
        if self._row is None:
            row, place, near = self.total.copy(), self, 4
            while place is not None and near:
                for word in place.words[::-1][:near]:
                    row[_path_slot(word)] += 0.5
                    near -= 1
                place = place.outer
            row[PATH_SIZE:] = self.outside, self.inside
            self._row = row
        return self._row


def _path_slot(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % PATH_SIZE


_TOP = Place(None, ())
_places: dict[tuple[int, tuple[str, ...]], Place] = {}  # by the place outside and the words; pages share them


def _place(outer: Place, words: tuple[str, ...]) -> Place:
    key = (id(outer), words)
    found = _places.get(key)
    if found is None or found.outer is not outer:
        found = _places[key] = Place(outer, words)
    return found


@dataclass
class Block:
    text: str
    place: Place  # the innermost open element
    linked: int  # characters inside links


def blocks(html: str) -> list[Block]:
    """The leaf blocks of a page in order, with character references decoded and spaces made single."""
    if len(_places) > PLACES_KEPT:
        _places.clear()
    found: list[Block] = []
    stack: list[tuple[str, Place]] = []
    still = Counter()  # open elements by name
    parts: list[str] = []
    links, at, linked = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            words = entities.unescape("".join(parts)).split()
            if words:
                found.append(Block(" ".join(words), stack[-1][1] if stack else _TOP, linked))
        parts.clear()
        linked = 0

    def close(name: str) -> None:
        nonlocal links
        while still[name]:  # what lies inside it ends with it
            tag = stack.pop()[0]
            still[tag] -= 1
            links -= tag == "a"
            if tag == name:
                return

    for m in _piece.finditer(html):
        begin, end = m.span()
        if begin > at:
            parts.append(html[at:begin])
            if links:
                linked += begin - at
        at = end
        _, closing, name, attributes = m.groups()
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK_TAGS:
            flush()
        if closing:
            close(name)
            continue
        if name in VOID_TAGS:
            continue
        if name in BLOCK_TAGS:
            close("p")  # a block ends an open paragraph
        while stack and stack[-1][0] in ENDED_BY.get(name, ()):
            close(stack[-1][0])
        said = [w for g in _named.findall(attributes) for v in g for w in _simple.findall(v.lower())] if attributes else ()
        words = (name, *("." + w for w in said))
        stack.append((name, _place(stack[-1][1] if stack else _TOP, words)))
        still[name] += 1
        links += name == "a"
    if at < len(html):
        parts.append(html[at:])
    flush()
    return found


class _Slots(dict):
    """word -> hashed slot, made when a word is first asked for."""

    def __missing__(self, word: str) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        found = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_SIZE
        return found


_slots = _Slots()
_marks = re.compile(r"[.,;:!?]")


def features(page: list[Block]) -> np.ndarray:
    """A row per block: hashed path, hashed words, and a few plain measures."""
    out = np.zeros((len(page), INPUT), dtype=np.float32)
    words = [b.text.split(" ") for b in page]
    counts = np.array([len(w) for w in words])
    sizes = np.array([len(b.text) for b in page])
    slots = np.fromiter(map(_slots.__getitem__, chain.from_iterable(words)), dtype=np.int64, count=counts.sum())
    slots += np.repeat(np.arange(len(page)) * WORD_SIZE, counts)
    bags = np.bincount(slots, minlength=len(page) * WORD_SIZE).reshape(-1, WORD_SIZE)
    paths = np.stack([b.place.row for b in page])
    out[:, :PATH_SIZE] = paths[:, :PATH_SIZE]
    out[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] = bags / np.sqrt(1.0 + counts**2)[:, None] * 4
    out[:, PATH_SIZE + WORD_SIZE :] = np.stack(
        [
            np.log1p(sizes) / 5,
            np.minimum(1, np.array([b.linked for b in page]) / sizes),
            np.minimum(1, 10 * np.array([len(_marks.findall(b.text)) for b in page]) / sizes),
            np.arange(len(page)) / max(1, len(page) - 1),
            [b.text[-1:] in ".!?:" for b in page],
            np.minimum(1, counts / 50),
            paths[:, PATH_SIZE],
            paths[:, PATH_SIZE + 1],
        ],
        axis=1,
    )
    return out


@dataclass
class Model:
    """Weights of both directions: input, state, bias of the four gates; then the output."""

    inward: np.ndarray  # [direction, INPUT, 4 * UNITS]
    state: np.ndarray  # [direction, UNITS, 4 * UNITS]
    bias: np.ndarray  # [direction, 4 * UNITS]
    out: np.ndarray  # [2 * UNITS]
    offset: np.ndarray  # [1]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(model: Model, x: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states [page, step, 2 * UNITS] and what the way back needs."""
    rows, steps, _ = x.shape
    hidden = np.zeros((rows, steps, 2 * UNITS), dtype=np.float32)
    kept = []
    for d in (0, 1):
        given = x @ model.inward[d] + model.bias[d]
        h = np.zeros((rows, UNITS), dtype=np.float32)
        c = np.zeros_like(h)
        trace = []
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            gates = given[:, t] + h @ model.state[d]
            i, f, o = (_sigmoid(gates[:, k * UNITS : (k + 1) * UNITS]) for k in range(3))
            g = np.tanh(gates[:, 3 * UNITS :])
            mask = real[:, t, None]
            c_new = (f * c + i * g) * mask
            squashed = np.tanh(c_new)
            trace.append((t, h, c, i, f, o, g, squashed))
            h, c = o * squashed, c_new
            hidden[:, t, d * UNITS : (d + 1) * UNITS] = h
        kept.append(trace)
    return hidden, kept


def scores(model: Model, x: np.ndarray, real: np.ndarray) -> np.ndarray:
    """The probability [page, step] that a block is content."""
    return _sigmoid(_run(model, x, real)[0] @ model.out + model.offset[0])


def _gradients(model: Model, x: np.ndarray, real: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
    hidden, kept = _run(model, x, real)
    p = _sigmoid(hidden @ model.out + model.offset[0])
    error = (p - wanted) * real / max(1.0, real.sum())
    g_out = np.einsum("rt,rth->h", error, hidden)
    into = error[:, :, None] * model.out
    g_in, g_state, g_bias = (np.zeros_like(m) for m in (model.inward, model.state, model.bias))
    for d in (0, 1):
        dh = np.zeros((x.shape[0], UNITS), dtype=np.float32)
        dc = np.zeros_like(dh)
        for t, h, c, i, f, o, g, squashed in reversed(kept[d]):
            dh = dh + into[:, t, d * UNITS : (d + 1) * UNITS]
            dc = (dc + dh * o * (1 - squashed**2)) * real[:, t, None]
            gates = np.concatenate(
                [dc * g * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g * g)],
                axis=1,
            )
            g_in[d] += x[:, t].T @ gates
            g_state[d] += h.T @ gates
            g_bias[d] += gates.sum(axis=0)
            dh = gates @ model.state[d].T
            dc = dc * f
    return [g_in, g_state, g_bias, g_out, np.array([error.sum()], dtype=np.float32)]


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((len(pages), steps, INPUT), dtype=np.float32)
    real = np.zeros((len(pages), steps), dtype=np.float32)
    for n, page in enumerate(pages):
        x[n, : len(page)], real[n, : len(page)] = page, 1
    return x, real


def train(pages: list[tuple[np.ndarray, np.ndarray]], seed: int = 11) -> Model:
    """A model from (features, labels) of pages; the same pages give the same model."""
    random = np.random.default_rng(seed)
    draw = lambda scale, *shape: random.normal(0, scale, shape).astype(np.float32)
    model = Model(
        draw(0.1, 2, INPUT, 4 * UNITS),
        draw(0.2, 2, UNITS, 4 * UNITS),
        np.zeros((2, 4 * UNITS), np.float32),
        draw(0.3, 2 * UNITS),
        np.zeros(1, np.float32),
    )
    parameters = [model.inward, model.state, model.bias, model.out, model.offset]
    first, second, step = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters], 0
    pages = [(x[:LONGEST], y[:LONGEST]) for x, y in pages if len(x)]
    rounds = EPOCHS * -(-len(pages) // BATCH) + 1
    for _ in range(EPOCHS):
        order = random.permutation(len(pages))
        for at in range(0, len(order), BATCH):
            part = [pages[n] for n in order[at : at + BATCH]]
            x, real = _padded([f for f, _ in part])
            # now and then hide the path, so that words and neighbours count too
            hidden = random.random((len(part), 1, PATH_SIZE)) < 0.1
            x[:, :, :PATH_SIZE] *= ~hidden
            wanted = np.zeros_like(real)
            for n, (_, y) in enumerate(part):
                wanted[n, : len(y)] = y
            grads = _gradients(model, x, real, wanted)
            step += 1
            rate = RATE * (1 - 0.9 * step / rounds)
            for p, g, m, v in zip(parameters, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def own_labels(page: list[Block]) -> np.ndarray | None:
    """1 for content, by the page's own elements; None where it has neither article nor main."""
    if not any(b.place.inside for b in page):
        return None
    return np.array([float(b.place.inside and not b.place.outside) for b in page], dtype=np.float32)


#: Ways to write what belongs to the article and what does not.
CONTENT_FRAMES = (
    "<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', '<div id="content">{}</div>',
    '<main><article class="post">{}</article></main>', '<div class="post-body entry">{}</div>',
    '<section class="story text">{}</section>', '<div id="main"><div class="article-body">{}</div></div>',
    '<article itemprop="articleBody"><section>{}</section></article>',
)
OUTSIDE_FRAMES = (
    "<nav><ul>{l}</ul></nav>", '<div class="menu"><ul>{l}</ul></div>', "<header><p>{s}</p>{l}</header>",
    '<div class="header"><h1>{s}</h1></div>', "<footer>&copy; {s} &middot; {t}</footer>",
    '<div id="footer"><p>{s}</p>{l}</div>', "<aside><h3>{s}</h3><ul>{l}</ul></aside>",
    '<div class="sidebar"><p>{t}</p>{l}</div>', '<div class="ad">{t}</div>', '<div class="advert"><p>{t}</p></div>',
    '<div class="cookie-notice"><p>{t}</p><button>{s}</button></div>', '<div class="notice"><p>{t}</p></div>',
    '<form><label>{s}</label><select><option>{s}</option></select><button>{s}</button></form>',
    '<form class="newsletter"><p>{t}</p></form>', '<div class="share social">{l}</div>',
    '<section class="related"><h2>{s}</h2><ul>{l}</ul></section>', '<div class="breadcrumb">{l}</div>',
    '<div role="banner"><p>{s}</p></div>', '<div class="popup subscribe"><p>{t}</p></div>',
)
COMMENT_FRAMES = (
    '<section class="comments"><h2>{s}</h2><div class="comment"><p>{t}</p></div><div class="comment"><p>{t}</p></div></section>',
    '<div id="comments"><ol><li class="comment"><p>{t}</p></li><li><p>{t}</p></li></ol></div>',
    '<div class="responses"><div class="reply"><b>{s}</b><p>{t}</p></div></div>',
)
_MARK = "\x01"


def template_page(random: np.random.Generator, words: list[str]) -> tuple[list[Block], np.ndarray]:
    """A page from the frames above, filled with ``words``, and the labels of its blocks."""

    def said(low: int, high: int, mark: str = "") -> str:
        return mark + " ".join(words[k] for k in random.integers(0, len(words), random.integers(low, high)))

    def some(frame: str) -> str:
        links = lambda: "".join(f'<li><a href="/x">{said(1, 3)}</a></li>' for _ in range(random.integers(2, 8)))
        while "{" in frame:
            frame = frame.replace("{l}", links(), 1).replace("{s}", said(1, 6), 1).replace("{t}", said(3, 40), 1)
        return frame

    def content() -> str:
        out = [f"<h1>{said(2, 10, _MARK)}</h1>"] if random.random() < 0.8 else []
        for _ in range(random.integers(1, 14)):
            kind = random.random()
            if kind < 0.75:
                out.append(f"<p>{said(1, 90, _MARK)}.</p>")
            elif kind < 0.82:
                out.append(f"<p><b>{said(1, 30, _MARK)}.<br>")
            elif kind < 0.88:
                out.append(f"<h2>{said(1, 8, _MARK)}</h2>")
            elif kind < 0.94:
                items = "".join(f"<li>{said(1, 15, _MARK)}</li>" for _ in range(random.integers(2, 6)))
                out.append(f"<ul>{items}</ul>")
            elif kind < 0.97:
                out.append(f"<blockquote>{said(3, 40, _MARK)}</blockquote>")
            else:
                out.append(some(OUTSIDE_FRAMES[random.integers(8, 12)]))
        return "".join(out)

    pick = lambda frames: frames[random.integers(0, len(frames))]
    around = lambda n: "".join(some(pick(OUTSIDE_FRAMES)) for _ in range(random.integers(0, n)))
    notes = some(pick(COMMENT_FRAMES)) if random.random() < 0.4 else ""
    body = pick(CONTENT_FRAMES).format(content() + (notes if random.random() < 0.5 else ""))
    page = f"<html><body>{around(4)}{body}{'' if notes in body and notes else notes}{around(4)}</body></html>"
    found = blocks(page)
    labels = np.array([float(_MARK in b.text) for b in found], dtype=np.float32)
    for b in found:
        b.text = b.text.replace(_MARK, "").strip()
    return found, labels


def sample_pages(pages: DataFrame) -> list[str]:
    """At most ``SAMPLE_PAGES`` pages, chosen by a hash of their ids, in the order of that hash."""
    h = F.xxhash64("page_id", F.lit("html"))
    keyed = pages.where("html is not null").select("html", h.alias("h")).withColumn(
        "slot", F.pmod("h", F.lit(SAMPLE_PAGES))
    )
    chosen = keyed.groupBy("slot").agg(F.min("h").alias("least")).drop("slot")
    rows = keyed.join(chosen, F.col("h") == F.col("least")).groupBy("h").agg(F.min("html").alias("html"))
    return [r["html"] for r in rows.orderBy("h").collect()]


def fitted(pages: DataFrame, seed: int = 5) -> Model:
    """A labeller trained on the page sample and on templates; without pages on templates alone."""
    sampled = [blocks(text) for text in sample_pages(pages)]
    cases = [(features(p), y) for p in sampled if (y := own_labels(p)) is not None]
    found = {w for p in sampled for b in p for w in b.text.split(" ")}
    words = sorted(found, key=lambda w: (zlib.crc32(w.encode("utf-8", "surrogatepass")), w))[:TEMPLATE_WORDS] or ["word", "other"]
    random = np.random.default_rng(seed)
    for _ in range(TEMPLATE_PAGES):
        page, labels = template_page(random, words)
        cases.append((features(page), labels))
    return train(cases)


#: Blocks read side by side, which bounds a task's memory.
READ_AT_ONCE = 6000


def main_texts(model: Model, pages: list[str]) -> list[str]:
    """The main text of each page."""
    cut = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((n for n, p in enumerate(cut) if p), key=lambda n: len(cut[n]))
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and (stop + 1 - at) * len(cut[order[stop]]) <= READ_AT_ONCE:
            stop += 1
        part = order[at:stop]
        x, real = _padded([features(cut[n]) for n in part])
        p = scores(model, x, real)
        for k, n in enumerate(part):
            out[n] = "\n".join(b.text for b, q in zip(cut[n], p[k], strict=False) if q >= 0.5)
        at = stop
    return out


def extracted(pages: DataFrame, model: Model, html: str = "html", name: str = "text") -> DataFrame:
    """Add the main text of every page; null and empty pages have an empty text.

    Pages of any length are read whole.  Repeated rows return a row each.  A column
    called ``name`` is replaced; all others pass through untouched.
    """

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            pages = [p or "" for p in batch]
            out: list[str] = []
            at = 0
            while at < len(pages):  # a few megabytes at a time
                stop, held = at, 0
                while stop < len(pages) and (stop == at or held + len(pages[stop]) <= 4 << 20):
                    held += len(pages[stop])
                    stop += 1
                out += main_texts(model, pages[at:stop])
                at = stop
            yield pd.Series(out, dtype=object)

    return pages.withColumn(name, extract(html))
