"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: text between block-level tags. A bidirectional LSTM reads, for each block in
page order, the mean vector of its hashed tag path (tags, class and ID words of all open elements), that of
its hashed words, and a few numbers, and labels every block in the light of all others. Kept blocks are
joined by line breaks.

The labeller is fitted on a bounded sample of the pages themselves. Their sections with a known meaning
(article, nav, footer ...) give the labels; each page is also dressed in other layouts, with its own text
under other tags and class names, so that context and not one template decides.
"""

from __future__ import annotations

import html as html_module
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pages that the labeller is fitted on, at most.
SAMPLE_PAGES = 240
LAYOUTS = 4
#: Share of the made layouts in which no name or tag tells a section, so that text and context must.
MASKED = 0.35
#: Where markup names no main text, blocks of fewer words are none.
PLAIN_WORDS = 10
PATHS, PATH_SIZE = 1 << 11, 12
WORDS, WORD_SIZE = 1 << 12, 8
NUMBERS, HIDDEN = 6, 24

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: An opened tag ends an open one of these, up to the nearest of the others.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Elements whose content holds no tags: up to their end tag, or without one the tag alone counts.
RAW_TAGS = frozenset("script style title textarea iframe noembed noframes xmp".split())
#: Elements with content of their own that is not shown.
HIDDEN_TAGS = frozenset("noscript template svg".split())
# An attribute with its value. A quote that holds angle brackets must be closed before white space, a slash or the
# tag's end; a stray quote is else part of a value that ends with the tag.
_ATTRIBUTE = (
    r"[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"<>]*+\"|'[^'<>]*+'|\"[^\"]*+\"(?=[\s/>]|\Z)|'[^']*+'(?=[\s/>]|\Z)|[^\s>]*+))?+"
)
_TAG = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE})*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)
_ATTRIBUTES = re.compile(_ATTRIBUTE, re.S)
_CLOSERS = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I) for tag in RAW_TAGS | HIDDEN_TAGS}
_NAMED = re.compile(r"class|id\b|role", re.I)
_LETTERS = re.compile(r"[a-z]+")


class _Hashed(dict):
    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, key: str) -> int:
        if len(self) > 500_000:
            self.clear()
        value = zlib.crc32(key.encode("utf-8", "replace")) % self.size
        self[key] = value
        return value


_path_ids, _word_ids = _Hashed(PATHS), _Hashed(WORDS)


@dataclass
class Block:
    text: str
    path: tuple[int, ...]
    linked: float
    tags: tuple[str, ...]
    mark: str


def attributes_of(rest: str) -> dict[str, str]:
    """Values by lower-case name of what follows a tag's name; of equal names the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTES.finditer(rest):
        name, _, value = m.group().partition("=")
        value = value.strip()
        if len(value) > 1 and value[0] in "\"'" and value[-1] == value[0]:
            value = value[1:-1]
        found.setdefault(name.rstrip().lower(), value)
    return found


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks of a page, in order. Text under script, style, head titles and the like is no block.

    Tags are read as attributes with their quotes. A quote that never closes ends with its tag, an element of raw or
    hidden text that never ends hides nothing after its start tag (a script or style all the rest), and an ``svg``
    ends where a block begins.
    """
    out: list[Block] = []
    # Open block elements: tag, hashed path, tags and mark down to it.
    stack: list[tuple[str, tuple[int, ...], tuple[str, ...], str]] = [("", (), (), "")]
    parts: list[str] = []
    links, link_chars, at, hidden = 0, 0, 0, 0
    page = page or ""
    ends: dict[str, re.Match | None] = {}

    def flush() -> None:
        nonlocal link_chars
        if parts:
            text = " ".join(html_module.unescape("".join(parts)).split())
            if text:
                _, path, tags, mark = stack[-1]
                out.append(Block(text, path, min(1.0, link_chars / len(text)), tags, mark))
            parts.clear()
        link_chars = 0

    def cut(k: int) -> None:
        nonlocal hidden
        hidden -= sum(frame[0] in HIDDEN_TAGS for frame in stack[k:])
        del stack[k:]

    def closer(tag: str, start: int) -> re.Match | None:
        """Next end tag after a place, looked for once until the reader is past it."""
        if tag not in ends or (ends[tag] is not None and ends[tag].start() < start):
            ends[tag] = _CLOSERS[tag].search(page, start)
        return ends[tag]

    while m := _TAG.search(page, at):
        if m.start() > at and not hidden:
            piece = page[at : m.start()]
            parts.append(piece)
            if links:
                link_chars += len(piece)
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag, closing, rest = tag.lower(), bool(m.group(1)), m.group(3)
        if tag in RAW_TAGS:
            if not closing:
                end = closer(tag, at)
                at = end.end() if end else len(page) if tag in ("script", "style") else at
            continue
        if tag in HIDDEN_TAGS:
            if closing:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        cut(k)
                        break
            elif not (tag == "svg" and rest.endswith("/")) and closer(tag, at):
                stack.append((tag, *stack[-1][1:]))
                hidden += 1
            continue
        if tag not in BLOCK_TAGS:
            if hidden:
                continue
            if tag == "a":
                links = max(0, links - 1) if closing else 1
            elif tag in VOID_TAGS:
                parts.append(" ")
            continue
        while stack[-1][0] == "svg":
            cut(len(stack) - 1)
        flush()
        links = 0
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    cut(k)
                    break
            continue
        if tag == "hr":
            continue
        if stack[-1][0] == "p":
            stack.pop()
        if tag in ENDS:
            same, outer = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in outer:
                    break
                if stack[k][0] in same:
                    cut(k)
                    break
        _, path, tags, mark = stack[-1]
        names: list[str] = []
        if rest and (_NAMED.search(rest) or "data-mark" in rest):
            values = attributes_of(rest)
            names = [w for a in ("class", "id", "role") for w in _LETTERS.findall(values.get(a, "").lower())]
            mark = values.get("data-mark", mark)
        own = (_path_ids[tag], *[_path_ids[f".{w}"] for w in names])
        stack.append((tag, path + own, (*tags, tag, *names), mark))
    if at < len(page) and not hidden:
        parts.append(page[at:])
    flush()
    return out


def vectors(pages: list[list[Block]]) -> tuple[np.ndarray, ...]:
    """Hashed paths and words of all blocks, end to end with their lengths, and the numbers."""
    path_ids, path_sizes, word_ids, word_sizes, numbers = [], [], [], [], []
    for blocks in pages:
        for i, b in enumerate(blocks):
            words = b.text.lower().split()
            path_ids.extend(b.path or (0,))
            path_sizes.append(len(b.path) or 1)
            word_ids.extend(map(_word_ids.__getitem__, words))
            word_sizes.append(len(words))
            numbers.append((np.log1p(len(b.text)) / 8, np.log1p(len(words)) / 6, b.linked, b.text[-1] in ".!?:;\"'”»", i / len(blocks), (len(blocks) - i) / len(blocks)))
    return np.array(path_ids), np.array(path_sizes), np.array(word_ids), np.array(word_sizes), np.array(numbers, np.float32).reshape(-1, NUMBERS)


def _means(table: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.add.reduceat(table[ids], starts, axis=0) / sizes[:, None]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Weights by name; ``f`` and ``r`` are the forward and the reverse direction."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int) -> Labeller:
        rng, size = np.random.default_rng(seed), PATH_SIZE + WORD_SIZE + NUMBERS
        w = {"path": rng.normal(0, 0.3, (PATHS, PATH_SIZE)), "word": rng.normal(0, 0.1, (WORDS, WORD_SIZE))}
        for d in "fr":
            w[f"x{d}"] = rng.normal(0, size**-0.5, (size, 4 * HIDDEN))
            w[f"h{d}"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
            w[f"b{d}"] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)])
        w["out"], w["bias"] = rng.normal(0, 0.1, 2 * HIDDEN), np.zeros(1)
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, x: np.ndarray, live: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """Hidden states of steps by rows; a row's state stays once it has ended."""
        steps, rows, _ = x.shape
        h, c = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, HIDDEN), np.float32)
        given = x @ self.weights[f"x{d}"] + self.weights[f"b{d}"]
        out, kept = np.empty((steps, rows, HIDDEN), np.float32), []
        for t in range(steps):
            z = given[t] + h @ self.weights[f"h{d}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            f, i, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            fresh = f * c + i * g
            squashed, on = np.tanh(fresh), live[t][:, None]
            kept.append((h, c, f, i, o, g, squashed))
            c, h = np.where(on, fresh, c), np.where(on, o * squashed, h)
            out[t] = h
        return out, kept

    def _back(self, x: np.ndarray, live: np.ndarray, d: str, kept: list, push: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        steps, rows, _ = x.shape
        dh, dc, dz = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, HIDDEN), np.float32), np.empty((steps, rows, 4 * HIDDEN), np.float32)
        by_h = np.zeros_like(self.weights[f"h{d}"])
        for t in reversed(range(steps)):
            h, c, f, i, o, g, squashed = kept[t]
            on = live[t][:, None]
            dh = dh + push[t]
            at_h, at_c = dh * on, dc * on
            at_c = at_c + at_h * o * (1 - squashed**2)
            dz[t] = np.concatenate([at_c * c * f * (1 - f), at_c * g * i * (1 - i), at_h * squashed * o * (1 - o), at_c * i * (1 - g**2)], 1)
            by_h += h.T @ dz[t]
            dh, dc = dh * ~on + dz[t] @ self.weights[f"h{d}"].T, dc * ~on + at_c * f
        flat = dz.reshape(-1, 4 * HIDDEN)
        grads = {f"x{d}": x.reshape(-1, x.shape[2]).T @ flat, f"h{d}": by_h, f"b{d}": flat.sum(0)}
        return dz @ self.weights[f"x{d}"].T, grads

    def _inputs(self, parts: tuple[np.ndarray, ...]) -> np.ndarray:
        path_ids, path_sizes, word_ids, word_sizes, numbers = parts
        return np.concatenate([_means(self.weights["path"], path_ids, path_sizes), _means(self.weights["word"], word_ids, word_sizes), numbers], 1)

    def forward(self, parts: tuple[np.ndarray, ...], lengths: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Scores of all blocks, end to end; pages have ``lengths`` blocks."""
        flat = self._inputs(parts)
        steps, row = int(lengths.max()), np.repeat(np.arange(len(lengths)), lengths)
        step = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        back = lengths[row] - 1 - step
        live = np.arange(steps)[:, None] < lengths
        xf = np.zeros((steps, len(lengths), flat.shape[1]), np.float32)
        xr = np.zeros_like(xf)
        xf[step, row], xr[back, row] = flat, flat
        hf, kf = self._run(xf, live, "f")
        hr, kr = self._run(xr, live, "r")
        both = np.concatenate([hf[step, row], hr[back, row]], 1)
        return both @ self.weights["out"] + self.weights["bias"], (xf, xr, live, kf, kr, both, step, back, row)

    def gradients(self, parts: tuple[np.ndarray, ...], lengths: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
        scores, (xf, xr, live, kf, kr, both, step, back, row) = self.forward(parts, lengths)
        share = np.clip(wanted.mean(), 0.05, 0.95)
        push = (_sigmoid(scores) - wanted) * np.where(wanted > 0, 0.5 / share, 0.5 / (1 - share)) / len(wanted)
        push = push.astype(np.float32)
        grads = {"out": both.T @ push, "bias": push.sum(keepdims=True)}
        by_state = push[:, None] * self.weights["out"]
        df, dr = np.zeros((*xf.shape[:2], HIDDEN), np.float32), np.zeros((*xf.shape[:2], HIDDEN), np.float32)
        df[step, row], dr[back, row] = by_state[:, :HIDDEN], by_state[:, HIDDEN:]
        at_f, more = self._back(xf, live, "f", kf, df)
        grads |= more
        at_r, more = self._back(xr, live, "r", kr, dr)
        grads |= more
        at = at_f[step, row] + at_r[back, row]
        path_ids, path_sizes, word_ids, word_sizes, _ = parts
        for name, ids, sizes, cols in (("path", path_ids, path_sizes, slice(0, PATH_SIZE)), ("word", word_ids, word_sizes, slice(PATH_SIZE, PATH_SIZE + WORD_SIZE))):
            grads[name] = np.zeros_like(self.weights[name])
            np.add.at(grads[name], ids, np.repeat(at[:, cols] / sizes[:, None], sizes, axis=0))
        return grads


#: Sections whose meaning markup tells.
KEPT_TAGS, LEFT_OUT_TAGS = {"article", "main"}, {"nav", "aside", "footer", "header", "form", "button", "select", "label"}
LEFT_OUT_NAMES = set(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie consent disqus footer header login masthead menu nav navbar "
    "navigation newsletter notice popup promo related reply share sidebar social sponsor sponsored subscribe widget".split()
)


def weak_label(block: Block) -> bool | None:
    """Whether markup says that the block is main text; None where it doesn't say."""
    for name in reversed(block.tags):
        if name in LEFT_OUT_TAGS or name in LEFT_OUT_NAMES:
            return False
        if name in KEPT_TAGS:
            return True
    return None


def plain_labels(blocks: list[Block]) -> list[bool]:
    """Labels for a page whose markup names no main text: long text with few links, or else the longest text."""
    own = [len(b.text) * (1 - b.linked) for b in blocks]
    found = [len(b.text.split()) >= PLAIN_WORDS and b.linked < 0.5 and weak_label(b) is not False for b in blocks]
    if not any(found) and any(own):
        found[int(np.argmax(own))] = True
    return found


_SECTIONS = {
    "header": "header div.header div#masthead div.top-bar div.site-head header.page-header div.branding".split(),
    "nav": "nav ul.menu div.navbar div#navigation div.breadcrumbs nav.main-nav div.tabs ul.nav-links div.menu".split(),
    "notice": "div.cookie-notice div.alert div#consent div.banner p.notice div.gdpr div.popup div.message div.announcement section.notice div.cookies".split(),
    "ad": "div.ad div.ads aside.sponsored div.promo div.advert div.advertisement div.banner-ad section.promoted div.sponsor div#ad-slot".split(),
    "side": "aside div.sidebar div#sidebar div.related div.widget section.recommended div.trending aside.more div.popular ul.see-also".split(),
    "form": "form form.search form.newsletter form#subscribe form.login form.contact".split(),
    "comments": "section.comments div#comments ol.comment-list div.discussion div.responses ul.replies div.reader-comments section#disqus div.feedback".split(),
    "footer": "footer div.footer div#colophon div.site-info div.copyright div.legal footer.site-footer div#bottom".split(),
    "main": "article main div.content div#content div.post div.entry-content section.story div.article-body div section div.text div.main div#main td.body div.page article.post".split(),
}
_PLAIN = "div section".split()


def _opaque(rng: np.random.Generator) -> str:
    """A name that says nothing."""
    return "".join(chr(97 + k) for k in rng.integers(0, 26, int(rng.integers(2, 8))))


def _opened(rng: np.random.Generator, kind: str, mark: str, masked: bool) -> tuple[str, str]:
    """An element of some section: its start and end tag. One in eight, or all if ``masked``, have a name that says nothing."""
    choices = _SECTIONS[kind]
    picked = choices[rng.integers(len(choices))] if not masked and rng.random() > 0.125 else f"{_PLAIN[rng.integers(2)]}.{_opaque(rng)}"
    tag, name, attribute = picked, "", ""
    for sign, attribute_name in ((".", "class"), ("#", "id")):
        if sign in picked:
            tag, _, name = picked.partition(sign)
            attribute = f' {attribute_name}="{name}"'
    return f'<{tag}{attribute} data-mark="{mark}">', f"</{tag}>"


def dressed(rng: np.random.Generator, content: list[str], junk: list[str], others: list[str]) -> str:
    """A page in some layout around the given text. ``junk`` is short text, ``others`` text of other pages."""
    masked = rng.random() < MASKED

    def words(low: int, high: int) -> str:
        source = (junk + others)[rng.integers(len(junk) + len(others))].split()
        start = rng.integers(len(source))
        return html_module.escape(" ".join(source[start : start + int(rng.integers(low, high + 1))]) or "x")

    def links() -> str:
        tag = ("li", "div", "span", "p")[rng.integers(4)]
        made = "".join(f'<{tag}><a href="/{i}">{words(1, 4)}</a></{tag}> ' for i in range(rng.integers(2, 9)))
        return f"<ul>{made}</ul>" if tag == "li" else made

    def section(kind: str) -> str:
        start, end = _opened(rng, kind, "drop", masked)
        if kind == "header":
            inner = f"<div>{words(1, 4)}</div>" + (links() if rng.random() < 0.5 else "")
        elif kind == "nav":
            inner = links()
        elif kind == "notice":
            inner = f"<p>{words(5, 25)}</p>" + (f"<button>{words(1, 2)}</button>" if rng.random() < 0.5 else "")
        elif kind == "ad":
            inner = words(3, 40) if rng.random() < 0.5 else f'<a href="/x">{words(3, 20)}</a>'
        elif kind == "side":
            inner = f"<h3>{words(1, 4)}</h3>" + (links() if rng.random() < 0.6 else f"<p>{words(5, 40)}</p><p>{words(5, 30)}</p>")
        elif kind == "form":
            inner = "".join(f"<label>{words(1, 4)}</label><input>" for _ in range(rng.integers(1, 4))) + f"<button>{words(1, 3)}</button>"
        elif kind == "comments":
            one = ("li", "div", "div" if masked else "article")[rng.integers(3)]
            each, author = (_opaque(rng), _opaque(rng)) if masked else ("comment", "author")
            by = ("div", "span", "h4")[rng.integers(3)]
            made = "".join(f'<{one} class="{each}"><{by} class="{author}">{words(1, 3)}</{by}><p>{words(4, 60)}</p></{one}>' for _ in range(rng.integers(1, 6)))
            inner = f"<h3>{words(1, 3)}</h3>{made}"
        else:
            inner = f"<p>{words(3, 15)}</p>" + (links() if rng.random() < 0.5 else "")
        return f"{start}{inner}{end}"

    def maybe(kind: str, chance: float) -> str:
        return section(kind) if rng.random() < chance else ""

    start, end = _opened(rng, "main", "keep", masked)
    body = []
    for i, text in enumerate(content):
        text = html_module.escape(text)
        tag = "h1" if i == 0 and rng.random() < 0.7 else ("p", "p", "p", "p", "p", "div", "blockquote", "li", "h2", "pre", "td")[rng.integers(11)]
        if rng.random() < 0.1:
            text = f'{text} <a href="/y">{words(1, 3)}</a>'
        body.append(f"<ul><{tag}>{text}</{tag}></ul>" if tag == "li" else f"<table><tr><{tag}>{text}</{tag}></tr></table>" if tag == "td" else f"<{tag}>{text}</{tag}>")
        if rng.random() < 0.06:
            body.append(section(("ad", "side", "notice", "form")[rng.integers(4)]))
    inside = maybe("comments", 0.15)
    top = [maybe("notice", 0.3), maybe("header", 0.6), maybe("nav", 0.7), maybe("form", 0.2), maybe("ad", 0.4), maybe("side", 0.3)]
    tail = [maybe("ad", 0.2), maybe("comments", 0.5), maybe("side", 0.4), maybe("form", 0.2), maybe("nav", 0.2), maybe("footer", 0.8), maybe("notice", 0.2)]
    if rng.random() < 0.3:
        rng.shuffle(top)
    outer = ("", "") if rng.random() < 0.5 else (f'<div class="{("wrapper", "container", "page", "layout")[rng.integers(4)]}">', "</div>")
    return f"<html><body>{outer[0]}{''.join(top)}{start}{''.join(body)}{inside}{end}{''.join(tail)}{outer[1]}</body></html>"


def examples(pages: list[str], layouts: int, seed: int) -> list[tuple[list[Block], np.ndarray]]:
    """Blocks and labels of the pages as they are and in other layouts.

    Pages without known sections are left out; if all are, text length and link share give the labels.
    """
    rng, found, out = np.random.default_rng(seed), [], []
    read = [(blocks, [weak_label(b) for b in blocks]) for blocks in map(blocks_of, pages)]
    if not any(any(labels) for _, labels in read):
        read = [(blocks, plain_labels(blocks)) for blocks, _ in read]
    for blocks, labels in read:
        content = [b.text for b, y in zip(blocks, labels, strict=True) if y]
        junk = [b.text for b, y in zip(blocks, labels, strict=True) if not y]
        if content:
            found.append((content, junk))
            # The layout at hand counts as much as each of two others.
            out += [(blocks, np.array([bool(y) for y in labels]))] * 2
    for i, (content, junk) in enumerate(found):
        others = found[(i + 1) % len(found)][0]
        for _ in range(layouts):
            some = content if rng.random() < 0.7 else content[: int(rng.integers(1, len(content) + 1))]
            blocks = blocks_of(dressed(rng, some, junk or ["-"], others))
            out.append((blocks, np.array([b.mark == "keep" for b in blocks])))
    return [x for x in out if x[0]]


def fit(samples: list[tuple[list[Block], np.ndarray]], seed: int = 0, rounds: int = 16, rate: float = 0.02) -> Labeller:
    model, rng = Labeller.fresh(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second, step = {k: np.zeros_like(v) for k, v in model.weights.items()}, 0
    samples = sorted(samples, key=lambda s: len(s[0]))
    groups = [samples[i : i + 32] for i in range(0, len(samples), 32)]
    ready = [(vectors([b for b, _ in g]), np.array([len(b) for b, _ in g]), np.concatenate([y for _, y in g]).astype(np.float32)) for g in groups]
    for turn in range(rounds):
        pace = rate * (1 - turn / rounds)
        for k in rng.permutation(len(ready)):
            step += 1
            grads = model.gradients(*ready[k])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            for name, g in grads.items():
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                model.weights[name] -= pace * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
    return model


def sampled(pages: DataFrame, html: str, most: int, seed: int) -> list[str]:
    """At most ``most`` distinct pages, those with the least hash.

    A share of the hashes, three times what is needed, is looked at, so that tasks send few pages however
    many of them there are. Copies of a page are one, here and in the share.
    """
    column = F.col(f"`{html}`")
    rows = pages.select(column.alias("html"), F.xxhash64(F.lit(seed), column).alias("h")).filter("html is not null")
    share = min(1.0, 3 * most / max(1, rows.agg(F.approx_count_distinct("h")).first()[0]))
    some = rows.filter(F.pmod("h", F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    return [r.html for r in some.distinct().orderBy("h", "html").limit(most).collect()]


def train(pages: DataFrame, html: str = "html", sample_pages: int = SAMPLE_PAGES, layouts: int = LAYOUTS, seed: int = 0) -> Labeller | None:
    """Fit on at most ``sample_pages`` distinct pages; None if none of them has text.

    The bound holds what comes to the driver: that many pages.
    """
    got = sampled(pages, html, sample_pages, seed)
    samples = examples(got, layouts, seed)
    return fit(samples, seed) if samples else None


def label(model: Labeller | None, pages: list[list[Block]]) -> list[np.ndarray]:
    """Which blocks of each page are main text. Without a model markup decides, or text where it is silent."""
    if model is None:
        marked = [[bool(weak_label(b)) for b in blocks] for blocks in pages]
        return [np.array(on if any(on) else plain_labels(blocks), bool) for on, blocks in zip(marked, pages, strict=True)]
    out: list[np.ndarray] = [np.empty(0, bool)] * len(pages)
    order = sorted((i for i, b in enumerate(pages) if b), key=lambda i: len(pages[i]))
    for start in range(0, len(order), 64):
        some = order[start : start + 64]
        lengths = np.array([len(pages[i]) for i in some])
        scores, _ = model.forward(vectors([pages[i] for i in some]), lengths)
        for i, part in zip(some, np.split(scores > 0, np.cumsum(lengths)[:-1]), strict=True):
            out[i] = part
    return out


def _extracted(batches: Iterator[pa.RecordBatch], model: Labeller | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            pages = [blocks_of(x.as_py()) for x in part.column(1)]
            kept = label(model, pages)
            texts = ["\n".join(b.text for b, y in zip(blocks, on, strict=True) if y) for blocks, on in zip(pages, kept, strict=True)]
            counts = pa.array([len(b) for b in pages], pa.int32()), pa.array([int(y.sum()) for y in kept], pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), *counts], names=["row", "text", "n_blocks", "n_kept"])


def extract(pages: DataFrame, model: Labeller | None, html: str = "html", carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of ``carry``, all columns by default), ``text``, ``n_blocks``, ``n_kept``.

    Character references are decoded, white space inside a block becomes one space, kept blocks are joined
    by line breaks. A null or empty page gives an empty text. Pages are worked on one by one, so repeated
    rows give the same; an empty table gives no rows. Columns stay inside ``row``, so names can't clash.
    """
    kept = pages.columns if carry is None else carry
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{html}`").alias("html"))
    shape = T.StructType([packed.schema["row"], *T._parse_datatype_string("text string, n_blocks int, n_kept int").fields])
    return packed.mapInArrow(lambda b: _extracted(b, model), shape)
