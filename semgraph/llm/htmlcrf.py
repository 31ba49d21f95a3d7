"""Main-text extraction by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: the runs of text between block-level tags,
scripts and styles left out.  Each block has features from its ancestors' tags
and class words and from its own text; neighbouring labels have weights too.
The model is trained on labelled pages, by default ones that a small generator
writes in several layouts, and Viterbi gives a page's best labels.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import textops as X

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</?[a-zA-Z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*>", re.S)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
#: Tags that are part of the text around them, as is any with a hyphen in its name.
INLINE = frozenset("a abbr acronym area audio b base bdi bdo big br cite code data del dfn em embed font i img ins kbd label link map mark meta meter output param picture progress q rb rp rt rtc ruby s samp slot small source span strike strong sub sup time track tt u var video wbr".split())
#: Tags whose content is no text; what stands before and after one is one text.
RAW = frozenset("script style noscript template textarea svg iframe object canvas".split())
#: Tags without an end.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag that ends an open one of the second kind.
ENDS = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
_CLOSE_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol pre section table ul".split())


@dataclass(frozen=True)
class Block:
    """A leaf block: its text with single spaces, the features of its ancestors, and the characters of it inside links."""

    text: str
    ancestors: frozenset[str]
    tag: str
    linked: int


def inline(name: str) -> bool:
    return name in INLINE or "-" in name


class _Open:
    """The open tags of a page: (name, features of it and all around it, place of the nearest block-level tag, -1 without one)."""

    def __init__(self, known: frozenset[str] | None):
        self.known, self.tags, self.count = known, [], Counter()

    def push(self, name: str, own: set[str]) -> None:
        around = self.tags[-1][1] if self.tags else frozenset()
        new = (own if self.known is None else own & self.known) - around
        self.tags.append((name, around | new if new else around, self.block() if inline(name) else len(self.tags)))
        self.count[name] += 1

    def cut(self, place: int) -> None:
        """Closes the tags from ``place`` on."""
        for name, _, _ in self.tags[place:]:
            self.count[name] -= 1
        del self.tags[place:]

    def block(self) -> int:
        return self.tags[-1][2] if self.tags else -1

    def last(self, name: str) -> int:
        """The place of the innermost tag of that name, which is open."""
        place = len(self.tags) - 1
        while self.tags[place][0] != name:
            place -= 1
        return place


def blocks(page: str, known: frozenset[str] | None = None) -> list[Block]:
    """The leaf blocks of a page in order; unclosed tags last to the end of their parent.

    Only block-level tags part blocks.  An end tag of nothing open is skipped
    (``</p>`` stands for an empty paragraph).  known: the features of ancestors that
    are wanted; with it the work grows with the page however deep its tags nest.
    """
    found: list[Block] = []
    tags = _Open(known)
    part: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", "".join(part)).strip()
        if text:
            tag, ancestors, _ = tags.tags[tags.block()] if tags.block() >= 0 else ("", frozenset(), -1)
            found.append(Block(text, ancestors, tag, linked))
        part.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw)
        part.append(text)
        if tags.count["a"]:
            linked += len(text)

    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        token = m[0]
        if token[1] in "!?":
            continue
        name = _NAME.match(token)[1].lower()
        if token[1] == "/":
            if not inline(name) and (tags.count[name] or name == "p"):
                flush()
            if tags.count[name]:
                tags.cut(tags.last(name))
            continue
        if name in RAW:
            at = re.compile(rf"</{name}\b[^>]*>|\Z", re.I).search(page, at).end()
            continue
        if not inline(name):
            flush()
            while name in _CLOSE_P or name in ENDS:
                block = tags.block()
                if block < 0 or tags.tags[block][0] not in (ENDS.get(name) or {"p"}):
                    break
                tags.cut(block)
        elif name == "br":
            part.append(" ")
        if name not in VOID and not token.endswith("/>"):
            own = {f"tag:{name}"}
            for a in _ATTRIBUTE.finditer(token):
                own.update(f"word:{w}" for w in _WORD.findall((a[2] or a[3] or a[4] or "").lower()))
            tags.push(name, own)
    flush()
    return found


def features(block: Block) -> set[str]:
    """Names of the features that hold for a block."""
    size, words = len(block.text), block.text.split()
    out = set(block.ancestors)
    out.add(f"leaf:{block.tag}")
    out.add(f"words:{min(7, len(words).bit_length())}")
    out.add(f"links:{min(3, 4 * block.linked // max(1, size))}")
    out.add(f"end:{'stop' if block.text[-1] in '.!?…' else 'other'}")
    out.add(f"commas:{min(3, block.text.count(','))}")
    if "©" in block.text:
        out.add("sign:copyright")
    return out


@dataclass(frozen=True)
class Crf:
    """Weights for label 1 (main text) against 0, and for pairs of labels."""

    weights: dict[str, float]
    bias: float
    pairs: tuple[tuple[float, float], tuple[float, float]]

    def labels(self, page: list[Block]) -> list[int]:
        """The likeliest labels of a page's blocks, by Viterbi."""
        if not page:
            return []
        (aa, ab), (ba, bb) = self.pairs
        get, back = self.weights.get, []
        zero = one = 0.0
        for i, block in enumerate(page):
            gain = self.bias + sum(get(f, 0.0) for f in features(block))
            if i:
                to_zero, to_one = ba + one > aa + zero, bb + one > ab + zero
                back.append((to_zero, to_one))
                zero, one = max(aa + zero, ba + one), max(ab + zero, bb + one)
            one += gain
        state = int(one > zero)
        path = [state]
        for to_zero, to_one in reversed(back):
            state = int(to_one if state else to_zero)
            path.append(state)
        return path[::-1]


class _Data:
    """Labelled pages as arrays: (at, where) of features by place, labels and which places are there."""

    def __init__(self, pages: list[tuple[list[Block], list[int]]]):
        self.names: dict[str, int] = {}
        at, where, truth, mask = [], [], [], []
        longest = max(len(p) for p, _ in pages)
        for n, (page, labels) in enumerate(pages):
            for i, block in enumerate(page):
                for f in sorted(features(block)):
                    at.append(n * longest + i)
                    where.append(self.names.setdefault(f, len(self.names)))
            truth.append(labels + [0] * (longest - len(labels)))
            mask.append([1.0] * len(labels) + [0.0] * (longest - len(labels)))
        self.at, self.where, self.y, self.live = np.array(at), np.array(where), np.array(truth), np.array(mask)
        self.both = self.live[:, 1:] * self.live[:, :-1]
        self.pairs = np.array([[(self.both * (self.y[:, :-1] == a) * (self.y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])


def objective(d: _Data, w: np.ndarray, bias: float, t: np.ndarray, l2: float) -> tuple[float, np.ndarray, float, np.ndarray]:
    """The negative log-likelihood a block, with an L2 penalty on ``w``, and its gradients, by forward-backward."""
    (n, longest), total, live = d.y.shape, d.live.sum(), d.live
    gain = bias + np.bincount(d.at, weights=w[d.where], minlength=n * longest).reshape(n, longest)
    emit = np.stack([np.zeros_like(gain), gain], axis=2)
    ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
    ahead[:, 0] = emit[:, 0]
    for i in range(1, longest):
        step = emit[:, i] + np.logaddexp(ahead[:, i - 1, 0, None] + t[0], ahead[:, i - 1, 1, None] + t[1])
        ahead[:, i] = np.where(live[:, i, None] > 0, step, ahead[:, i - 1])
    whole = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    for i in range(longest - 2, -1, -1):
        nxt = emit[:, i + 1] + behind[:, i + 1]
        step = np.logaddexp(t[:, 0] + nxt[:, None, 0], t[:, 1] + nxt[:, None, 1])
        behind[:, i] = np.where(live[:, i + 1, None] > 0, step, 0.0)
    p = np.exp(ahead[:, :, 1] + behind[:, :, 1] - whole[:, None]) * live
    off = (p - d.y * live) / total
    joint = np.exp(ahead[:, :-1, :, None] + t + (emit + behind)[:, 1:, None, :] - whole[:, None, None, None]) * d.both[:, :, None, None]
    loss = (whole.sum() - (gain * d.y * live).sum() - (d.pairs * t).sum()) / total + l2 / (2 * n) * (w**2).sum()
    return float(loss), np.bincount(d.where, weights=off.ravel()[d.at], minlength=len(w)) + l2 * w / n, float(off.sum()), (joint.sum(axis=(0, 1)) - d.pairs) / total


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = 200, l2: float = 1e-3, rate: float = 0.3) -> Crf:
    """Fits the field by AdaGrad on the mean log-likelihood."""
    d = _Data(pages)
    w, bias, t = np.zeros(len(d.names)), 0.0, np.zeros((2, 2))
    gw, gb, gt = np.full(len(w), 1e-6), 1e-6, np.full((2, 2), 1e-6)
    for _ in range(rounds):
        _, dw, db, dt = objective(d, w, bias, t, l2)
        gw, gb, gt = gw + dw**2, gb + db**2, gt + dt**2
        w, bias, t = w - rate * dw / np.sqrt(gw), bias - rate * db / np.sqrt(gb), t - rate * dt / np.sqrt(gt)
    return Crf(dict(zip(d.names, w.tolist(), strict=True)), bias, tuple(map(tuple, t.tolist())))


def labelled_pages(count: int = 240, seed: int = 5) -> list[tuple[list[Block], list[int]]]:
    """Pages in several layouts with the label of each block.

    Main text is written between the characters \\x01 and \\x02, which are taken
    off the blocks again; blocks are labelled 1 if they had them.
    """
    rng = np.random.default_rng(seed)
    pick = lambda *x: x[rng.integers(len(x))]
    word = lambda: "".join(pick("th", "er", "on", "an", "re", "he", "in", "ed", "la", "mi", "so") for _ in range(rng.integers(1, 5)))
    words = lambda a, b: " ".join(word() + pick("", "", "", "", ",") for _ in range(rng.integers(a, b)))
    sentence = lambda a=2, b=14: words(a, b).capitalize().rstrip(",") + pick(".", ".", ".", "!", "?", "")
    sentences = lambda a, b: " ".join(sentence() for _ in range(rng.integers(a, b)))
    main = lambda text: f"\x01{text}\x02"

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(n)) + "</ul>"

    def off(kind: str) -> str:
        inner = pick(f"<p>{sentences(1, 4)}</p>", sentences(1, 3), links(rng.integers(2, 7)), f"<h3>{words(1, 4)}</h3><p>{sentences(1, 3)}</p>", f'<a href="/x">{words(2, 6)}</a>')
        names = {
            "ad": ("ad", "ads", "advert", "advertisement", "banner", "promo", "sponsored"),
            "side": ("sidebar", "side", "widget", "related", "recommended", "trending"),
            "notice": ("cookie notice", "notice", "alert", "consent", "popup", "newsletter subscribe"),
            "comment": ("comments", "comment", "reader comments", "discussion replies"),
            "bar": ("breadcrumb", "menu", "share social", "tags meta", "pagination", "toolbar"),
        }[kind]
        tag = {"side": pick("aside", "div"), "comment": pick("section", "div", "ul"), "ad": pick("div", "aside", "section")}.get(kind, pick("div", "section"))
        return f'<{tag} {pick("class", "id")}="{pick(*names)}">{inner}</{tag}>'

    def body_block() -> str:
        text = main(pick(sentences(1, 9), sentences(2, 5), sentence(1, 4)))
        kind = rng.random()
        if kind < 0.7:
            return f"<p>{text}" + pick("</p>", "</p>", "")
        if kind < 0.78:
            return f"<p><b>{text}<br>"
        if kind < 0.86:
            return f"<{pick('h2', 'h3')}>{main(words(1, 7))}</{pick('h2', 'h3')}>"
        if kind < 0.93:
            return "<ul>" + "".join(f"<li>{main(sentence(2, 12))}</li>" for _ in range(rng.integers(2, 5))) + "</ul>"
        return f"<{pick('blockquote', 'pre')}>{text}</{pick('blockquote', 'pre')}>"

    pages = []
    for _ in range(count):
        inside = [f"<h1>{main(words(2, 10))}</h1>"] * int(rng.random() < 0.9)
        for _ in range(rng.integers(1, 12)):
            inside.append(body_block())
            if rng.random() < 0.12:
                inside.append(off(pick("ad", "side", "bar", "notice")))
        if rng.random() < 0.2:
            inside.append(off("comment"))
        wrap = pick("<article>{}</article>", "<article>{}</article>", "<main><article>{}</article></main>", "<main>{}</main>", '<div class="content">{}</div>', '<div id="main"><div class="post article">{}</div></div>', '<div class="entry content">{}</div>')
        for _ in range(rng.integers(0, 4) * (rng.random() < 0.5)):
            wrap = pick("<div>{}</div>", "<section>{}</section>", f'<div class="{pick("page", "wrapper", "container", "layout", "row", "col", word())}">{{}}</div>').replace("{}", wrap)
        before = [f"<nav>{links(rng.integers(3, 8))}</nav>", pick("", f"<header><h2>{words(1, 3)}</h2>{links(3)}</header>", f'<header class="site header"><p>{sentence()}</p></header>', f'<div class="header">{links(4)}</div>')]
        before += [off(pick("ad", "notice", "bar")) for _ in range(rng.integers(0, 3))]
        after = [off(pick("side", "ad", "comment", "bar", "notice")) for _ in range(rng.integers(0, 4))]
        after += [pick("", f"<form><label>{words(1, 3)}</label><p>{sentence()}</p><button>{word()}</button></form>")]
        after += [pick(f"<footer>&copy; {word()}.example &middot; {sentence()}</footer>", f"<footer><p>{sentences(1, 3)}</p>{links(3)}</footer>", f'<div class="footer">&copy; {words(2, 5)}</div>')]
        page = f"<html><head><title>{words(2, 9)}</title></head><body>" + "".join(before) + wrap.format("".join(inside)) + "".join(after) + "</body></html>"
        found = blocks(page)
        labels = ["\x01" in b.text for b in found]
        found = [Block(b.text.replace("\x01", "").replace("\x02", "") or "-", b.ancestors, b.tag, b.linked) for b in found]
        pages.append((found, [int(x) for x in labels]))
    return pages


@lru_cache(maxsize=1)
def default_model() -> Crf:
    return train(labelled_pages())


def main_text(page: str | None, model: Crf) -> str:
    """The main text of one page: its blocks of label 1, two line breaks between them."""
    found = blocks(page or "", frozenset(model.weights))
    return "\n\n".join(b.text for b, label in zip(found, model.labels(found), strict=True) if label)


def extract(pages: DataFrame, model: Crf | None = None, column: str = "html") -> DataFrame:
    """``pages`` without ``html`` and with ``text`` and ``n_chars`` (its code points) added, replacing columns of those names.

    A null or empty page has an empty text, as has one without main text.  Whole
    pages are read, in one pass without a shuffle; repeated rows each give a row,
    an empty table gives an empty one, and tags may nest to any depth.
    Of equally likely labellings a block's label is 0, and so is that before it.
    """
    model = model or default_model()
    carried = [f for f in pages.schema.fields if f.name not in (column, "text", "n_chars")]
    schema = T.StructType([*carried, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column_ = X.texts(batch.column(batch.schema.get_field_index(column)))
            for lo, hi in X.steps(column_):
                found = [main_text(x.as_py(), model) for x in column_.slice(lo, hi - lo)]
                own = [batch.column(batch.schema.get_field_index(f.name)).slice(lo, hi - lo) for f in carried]
                yield pa.RecordBatch.from_arrays([*own, pa.array(found, type=pa.string()), pa.array(list(map(len, found)), type=pa.int64())], names=[f.name for f in schema.fields])

    return pages.mapInArrow(X.tidied(run), schema)
