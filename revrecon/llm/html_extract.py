"""Main text of web pages: a bidirectional LSTM labels every block from its tag path, its words and the whole page."""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrecon.llm.common import slices, table

#: Pages that the labeller is fitted on at most, chosen by a hash of page_id; blocks of a training sequence.
SAMPLE, CROP = 400, 48
HASHED, HIDDEN, STEPS, BATCH, RATE = 24, 16, 220, 32, 0.02
#: Elements that begin and end a block, elements whose content is no text, elements without content.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
SILENT = frozenset("head script style template iframe".split())
RAW = frozenset("script style textarea title iframe".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Inline elements that stand apart from the text around them, elements that part words; elements that a browser
#: never shows inside the named one (tooltips and descriptions of drawings, sources of formulas).
APART = frozenset("noscript textarea object canvas audio video select button".split())
SPACED = frozenset("br text mtd".split())
UNSEEN = {"title": "svg", "desc": "svg", "metadata": "svg", "annotation": "math", "annotation-xml": "math"}
#: Elements that may stand in a head; any other one, or text, ends a head that is open.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: An open element that the next one ends by itself.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Words of tags and attributes by which the teacher tells what is not main text.
SIDE_TAGS = frozenset("nav footer aside form header menu dialog button label input".split())
SIDE_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies copyright discussion disqus footer form header "
    "login masthead menu modal nav navbar navigation newsletter notice popup promo promoted related replies reply respond share sharing "
    "sidebar signup social sponsor sponsored subscribe tags toolbar widget".split()
)
#: Elements around an article in which training pages set their blocks anew, and the leaves within them: for
#: paragraphs, and for the parts between them (headings, lists, definitions, captions, tables, quotations, code).
MAIN_ROOTS = ("body main", "body div.content", "body div.post-body", "body article section", "body div#main div.entry", "body article div.text", "body main article", "body article", "body div#content", "body div.page div.story")
MAIN_LEAVES = ("p", "p", "p", "p", "div", "blockquote p", "table tr td p")
PART_LEAVES = (
    "h2", "h2", "h3", "h4", "ul li", "ul li", "ul li p", "ol li", "ol li", "dl dt", "dl dd", "figure figcaption", "figure.image figcaption",
    "table caption", "table tr th", "table tbody tr td", "blockquote", "pre", "section h2", "div h3", "div ul li",
)
#: Paths of other text.
SIDE_PATHS = (
    "body header div", "body header h2", "body div.sidebar p", "body aside div p", "body aside ul li", "body div.comments div.comment p",
    "body section#comments ol li p", "body form label", "body form p", "body div.cookie-notice p", "body div.notice", "body div.ad",
    "body div.advert p", "body nav ul li", "body div.menu ul li", "body footer p", "body div#footer div", "body div.related ul li",
    "body article div.share", "body article aside p", "body article section.comments p", "body article footer p", "body div.newsletter p",
)
NAME_END, SPECIAL = re.compile(r"[\s/>]"), re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[A-Za-z]+")


class Path:
    """An element's tag and attribute words, and the element around it, which all elements within share."""

    __slots__ = ("above", "words", "side", "_vector")

    def __init__(self, above: Path | None, words: tuple[str, ...]):
        self.above, self.words, self._vector = above, words, None
        self.side = above is not None and above.side or any(w in SIDE_TAGS or w[1:] in SIDE_WORDS for w in words)

    def all_words(self) -> tuple[str, ...]:
        parts, node = [], self
        while node is not None:
            parts.append(node.words)
            node = node.above
        return tuple(w for words in reversed(parts) for w in words)

    def vector(self) -> np.ndarray:
        """Three hashed vectors of all words, each the sum of the element's own and those of the path around it."""
        waiting, node = [], self
        while node is not None and node._vector is None:
            waiting.append(node)
            node = node.above
        for node in reversed(waiting):
            own = _words_vector(node.words)
            node._vector = own if node.above is None else node.above._vector + own
        return self._vector


@dataclass
class Block:
    node: Path | tuple[str, ...]
    text: str
    linked: int

    def __post_init__(self) -> None:
        if isinstance(self.node, tuple):
            self.node = Path(None, self.node)

    @property
    def path(self) -> tuple[str, ...]:
        return self.node.all_words()


def markup(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """Comments, declarations and tags of a page: begin, end, tag ('' for the first two), whether it closes, attributes.

    Time is linear in the page, whatever it holds. A tag ends at the first ">" outside quotes; one without it is text.
    What follows a quote or ">" that an earlier tag came to without reaching its own end is not read again. To go on
    elsewhere, send the position.
    """
    at, name_end, first = 0, -1, -1
    last = {c: page.rfind(c) for c in "\"'>"}
    hopeless: set[int] = set()
    while (at := page.find("<", at)) >= 0:
        begin, mark, end = at, page[at + 1 : at + 2], -1
        tag, rest = "", ""
        if page.startswith("<!--", at):
            end = page.find("-->", at) + 3
            end = end if end >= 3 else len(page)
        elif mark in ("!", "?"):
            end = page.find(">", at) + 1 or len(page)
        else:
            closing = mark == "/"
            start = at + 1 + closing
            if page[start : start + 1].isascii() and page[start : start + 1].isalpha() and last[">"] > start:
                if name_end < start:
                    name_end = NAME_END.search(page, start).start()
                if first < name_end:
                    first = SPECIAL.search(page, name_end).start()
                special, seen = first, []
                while special not in hopeless:
                    if page[special] == ">":
                        tag, rest, end = page[start:name_end], page[name_end:special], special + 1
                        break
                    seen.append(special)
                    if last[page[special]] <= special or last[">"] < special:
                        break
                    close = page.find(page[special], special + 1)
                    found = SPECIAL.search(page, close + 1)
                    if found is None:
                        break
                    special = found.start()
                if end < 0:
                    hopeless.update(seen)
        if end < 0:
            at += 1
            continue
        moved = yield begin, end, tag.lower(), mark == "/", rest
        at = end if moved is None else moved


def blocks_of(page: str) -> list[Block]:
    """The page's leaf blocks in order: the tags and attribute words above each, its text, its characters in links.

    Comments (``<!-->`` is an empty one), markup and what a browser never shows (scripts, styles, heads, templates, frames, ``UNSEEN``) are no text.
    Open elements that a page never closes end with the element around them; a head ends where text or an element begins
    that cannot stand in it. A broken tag at the end is text. Blocks share their paths, so time and memory are linear in
    the page, however many elements stay open.
    """
    out: list[Block] = []
    stack: list[tuple[str, Path, bool]] = []
    opened: Counter[str] = Counter()
    unclosed: set[str] = set()
    parts: list[str] = []
    linked = silent = links = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append(Block(stack[-1][1] if stack else ROOT, text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if silent and stack[-1][0] == "head" and "<" not in text and text.strip():
            pop()
        if text and not silent:
            parts.append(text)
            if links:
                linked += len(text)

    def pop() -> None:
        nonlocal silent, links
        tag, _, hidden = stack.pop()
        opened[tag] -= 1
        silent -= hidden
        links -= tag == "a"

    def end_tag(tag: str, start: int) -> re.Match | None:
        found = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, start)
        if found is None:
            unclosed.add(tag)
        return found

    tokens, moved = markup(page), None
    while True:
        try:
            begin, end, tag, closing, rest = tokens.send(moved)
        except StopIteration:
            break
        add(page[at:begin])
        at, moved = end, None
        if not tag:
            continue
        if tag in BLOCKS or tag in SILENT or tag in APART:
            flush()
        elif tag in SPACED:
            add(" ")
        if closing:
            if opened[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if silent and stack[-1][0] == "head":
            if tag not in IN_HEAD:
                pop()
            elif tag == "noscript":
                close = end_tag(tag, at)
                at = moved = close.end() if close else at
                continue
        ends = CLOSES.get(tag, ("p",) if tag in BLOCKS else ())
        while stack and (stack[-1][0] in ends or stack[-1][0] in ("b", "i", "em", "strong", "span", "a", "u", "font") and tag in BLOCKS and any(t in ends for t, *_ in stack[-4:])):
            pop()
        if tag in EMPTY or rest.endswith("/"):
            continue
        words = tuple(f".{w.lower()}" for a in ATTRIBUTE.finditer(rest) for w in WORD.findall(a[1] or a[2] or a[3] or ""))
        hidden = tag in SILENT or tag in UNSEEN and opened[UNSEEN[tag]] > 0
        stack.append((tag, Path(stack[-1][1] if stack else None, (tag, *words)), hidden))
        opened[tag] += 1
        silent += hidden
        links += tag == "a"
        if tag in RAW:
            close = end_tag(tag, at)
            stop = close.start() if close else len(page)
            if tag in ("title", "textarea"):
                add(page[at:stop])
            at = moved = stop
    add(page[at:])
    flush()
    return out


def teacher(block: Block) -> bool:
    """Whether the rules take a block for main text; the labeller is trained on these and on pages set anew."""
    return not block.node.side


_SLOTS: dict[str, int] = {}


def _slot(word: str) -> int:
    if word not in _SLOTS:
        if len(_SLOTS) > 500_000:
            _SLOTS.clear()
        _SLOTS[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
    return _SLOTS[word]


def _hashed(texts: list[list[str]]) -> np.ndarray:
    """A vector of HASHED numbers for the words of each text."""
    n = np.array([len(t) for t in texts], np.int64)
    h = np.fromiter((_slot(w) for t in texts for w in t), np.uint64, int(n.sum()))
    signs = 1.0 - 2.0 * ((h >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    at = np.repeat(np.arange(len(texts)) * HASHED, n) + (h % np.uint64(HASHED)).astype(np.int64)
    sums = np.bincount(at, signs, len(texts) * HASHED).reshape(len(texts), HASHED)
    return sums / np.sqrt(np.maximum(1, n))[:, None]


NUMBERS = 8
#: Path words have vectors of their own, as wide as three word vectors: they are few and say most.
WIDTH = 4 * HASHED + NUMBERS


_WORDS: dict[tuple[str, ...], np.ndarray] = {}


def _words_vector(words: tuple[str, ...]) -> np.ndarray:
    """Three hashed vectors of an element's words; layouts repeat, so a worker keeps those it has met."""
    if words not in _WORDS:
        if len(_WORDS) > 50_000:
            _WORDS.clear()
        out = np.zeros(3 * HASHED, np.int32)
        for p in words:
            for k, salt in enumerate("abc"):
                h = _slot(salt + p)
                out[k * HASHED + h % HASHED] += 1 - 2 * (h >> 40 & 1)
        _WORDS[words] = out
    return _WORDS[words]


ROOT = Path(None, ())


def describe(blocks: list[Block]) -> np.ndarray:
    """A row per block: hashed path words, hashed text words, length, links and marks."""
    out = np.zeros((len(blocks), WIDTH))
    if not blocks:
        return out
    words, last = [b.text.lower().split() for b in blocks], max(1, len(blocks) - 1)
    out[:, : 3 * HASHED] = [b.node.vector() for b in blocks]
    out[:, 3 * HASHED : 4 * HASHED] = _hashed(words)
    out[:, 4 * HASHED :] = [
        (math.log1p(len(w)) / 4, b.linked / len(b.text), min(1.0, 10 * _marks(b.text) / len(b.text)), "©" in b.text,
         b.text[-1] in ".!?…", k / last, b.node.words[-1:] == ("p",), 1.0)
        for k, (b, w) in enumerate(zip(blocks, words, strict=True))
    ]
    return out


def _marks(text: str) -> int:
    return sum(map(text.count, ".,;:!?"))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs over a page's blocks, one in each direction, and a logistic output on both states."""

    def __init__(self, width: int = WIDTH, hidden: int = HIDDEN, seed: int = 3):
        rng, self.hidden = np.random.default_rng(seed), hidden
        self.w = {}
        for side in "fb":
            self.w["W" + side] = rng.normal(scale=0.25 / np.sqrt(hidden), size=(width + hidden, 4 * hidden))
            self.w["B" + side] = np.zeros(4 * hidden)
            self.w["B" + side][hidden : 2 * hidden] = 1
        self.w["O"], self.w["C"] = rng.normal(scale=0.2, size=2 * hidden), np.zeros(1)

    def _run(self, side: str, x: np.ndarray, mask: np.ndarray, keep_gates: bool = True) -> tuple[np.ndarray, list]:
        """States for x (steps, pages, width); a masked step keeps the state as it was."""
        h_size, weights, bias = self.hidden, self.w["W" + side], self.w["B" + side]
        h = c = np.zeros((x.shape[1], h_size))
        drive, recurrent = x @ weights[: x.shape[2]] + bias, weights[x.shape[2] :]
        out, saved = np.zeros((*x.shape[:2], h_size)), []
        for t in range(x.shape[0]) if side == "f" else range(x.shape[0] - 1, -1, -1):
            z = drive[t] + h @ recurrent
            i, f, o = (_sigmoid(z[:, k * h_size : (k + 1) * h_size]) for k in range(3))
            g, keep = np.tanh(z[:, 3 * h_size :]), mask[t][:, None]
            c_new = np.where(keep, f * c + i * g, c)
            tc = np.tanh(c_new)
            h_new = np.where(keep, o * tc, h)
            if keep_gates:
                saved.append((t, h, c, i, f, o, g, tc, keep))
            h, c = h_new, c_new
            out[t] = h
        return out, saved

    def forward(self, x: np.ndarray, mask: np.ndarray, keep_gates: bool = True) -> tuple[np.ndarray, dict]:
        f, saved_f = self._run("f", x, mask, keep_gates)
        b, saved_b = self._run("b", x, mask, keep_gates)
        both = np.concatenate([f, b], axis=2)
        return _sigmoid(both @ self.w["O"] + self.w["C"]), {"both": both, "f": saved_f, "b": saved_b}

    def gradients(self, x: np.ndarray, mask: np.ndarray, want: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss over the blocks and its gradients, back through time."""
        p, memo = self.forward(x, mask)
        n, eps, size = max(1, mask.sum()), 1e-9, self.hidden
        loss = -float((np.where(want, np.log(p + eps), np.log(1 - p + eps)) * mask).sum() / n)
        d = (p - want) * mask / n
        out = {"O": np.einsum("tp,tph->h", d, memo["both"]), "C": np.array([d.sum()])}
        for k, side in enumerate("fb"):
            recurrent = self.w["W" + side][x.shape[2] :]
            d_out = d[:, :, None] * self.w["O"][k * size : (k + 1) * size]
            dz_all, dh, dc = np.zeros((*x.shape[:2], 4 * size)), np.zeros((x.shape[1], size)), np.zeros((x.shape[1], size))
            d_rec = np.zeros_like(recurrent)
            for t, h, c, i, f, o, g, tc, keep in reversed(memo[side]):
                dh = dh + d_out[t]
                d_c = dc + np.where(keep, dh * o * (1 - tc * tc), 0)
                dz = np.concatenate([d_c * g * i * (1 - i), d_c * c * f * (1 - f), dh * tc * o * (1 - o), d_c * i * (1 - g * g)], axis=1) * keep
                dz_all[t] = dz
                d_rec += h.T @ dz
                dh = np.where(keep, dz @ recurrent.T, dh)
                dc = np.where(keep, d_c * f, dc)
            d_in = np.einsum("tpw,tpz->wz", x, dz_all, optimize=True)
            out["W" + side], out["B" + side] = np.concatenate([d_in, d_rec]), dz_all.sum(axis=(0, 1))
        return loss, out

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS, seed: int = 5) -> Labeller:
        """Adam over random batches of crops of the pages."""
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        for step in range(1, steps + 1 if pages else 1):
            crops = []
            for k in rng.integers(0, len(pages), BATCH):
                x, y = pages[k]
                lo = int(rng.integers(0, len(x) - CROP + 1)) if len(x) > CROP else 0
                crops.append((x[lo : lo + CROP], y[lo : lo + CROP]))
            x, mask, want = padded([c[0] for c in crops], [c[1] for c in crops])
            _, grads = self.gradients(x, mask, want)
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rate = RATE / (1 + 2 * step / steps)
                self.w[k] = self.w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def labels(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page whether each block is main text. Pages of like length go together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order, at = sorted(range(len(pages)), key=lambda k: len(pages[k])), 0
        while at < len(order):
            lot = [order[at]]
            while at + len(lot) < len(order) and len(lot) < 256 and (len(lot) + 1) * len(pages[order[at + len(lot)]]) <= 20_000:
                lot.append(order[at + len(lot)])
            at += len(lot)
            x, mask, _ = padded([pages[k] for k in lot])
            if len(x):
                p, _ = self.forward(x, mask, keep_gates=False)
                for n, k in enumerate(lot):
                    out[k] = p[: len(pages[k]), n] >= 0.5
        return out


def padded(xs: list[np.ndarray], ys: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = max(map(len, xs), default=0)
    x, mask, want = np.zeros((steps, len(xs), WIDTH)), np.zeros((steps, len(xs)), bool), np.zeros((steps, len(xs)), bool)
    for n, rows in enumerate(xs):
        x[: len(rows), n], mask[: len(rows), n] = rows, True
        if ys is not None:
            want[: len(rows), n] = ys[n]
    return x, mask, want


def _path(text: str) -> tuple[str, ...]:
    return tuple(w for part in text.split() for w in (re.split(r"[.#]", part)[0], *(f".{x}" for a in re.split(r"[.#]", part)[1:] for x in WORD.findall(a))))


def _excerpt(text: str, rng: np.random.Generator) -> str:
    """One to fourteen neighbouring words, as they stand in headings, list items and captions."""
    words = text.split()
    at = int(rng.integers(len(words)))
    return " ".join(words[at : at + int(rng.integers(1, 15))])


def set_anew(blocks: list[Block], spare: list[Block], rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """The page's main blocks in another layout, with headings, lists and captions cut from them, among side blocks in side paths."""
    main = [b for b in blocks if teacher(b)]
    root, leaf = MAIN_ROOTS[rng.integers(len(MAIN_ROOTS))], MAIN_LEAVES[rng.integers(len(MAIN_LEAVES))]
    path = Path(None, _path(f"{root} {leaf}"))
    out: list[tuple[Block, bool]] = []
    for b in main:
        heading = b.node.words[:1] in (("h1",), ("h2",), ("h3",)) and rng.random() < 0.5
        out.append((Block(b.node if heading else path, b.text, 0), True))
        if rng.random() < 0.3:
            part = Path(None, _path(f"{root} {PART_LEAVES[rng.integers(len(PART_LEAVES))]}"))
            many = 1 if part.words[-1] in ("h2", "h3", "h4", "figcaption", "caption") else int(rng.integers(1, 6))
            out += [(Block(part, _excerpt(main[rng.integers(len(main))].text, rng), 0), True) for _ in range(many)]
    for _ in range(int(rng.integers(2, 7))):
        side = _path(SIDE_PATHS[rng.integers(len(SIDE_PATHS))])
        at = int(rng.choice([0, len(out), rng.integers(0, len(out) + 1)]))
        for _ in range(int(rng.integers(1, 4))):
            b = spare[rng.integers(len(spare))] if spare and rng.random() < 0.6 or not main else main[rng.integers(len(main))]
            out.insert(at, (Block(side, b.text, len(b.text) if side[-1] == "li" and rng.random() < 0.7 else 0), False))
    return [b for b, _ in out], np.array([y for _, y in out], bool)


def learn(pages: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> Labeller:
    """A labeller from at most ``sample`` pages: as they are, labelled by the teacher, and set anew in other layouts."""
    n = pages.count()
    place = F.pmod(F.xxhash64(F.col("page_id").cast("long"), F.coalesce(F.col("html"), F.lit(""))), F.lit(1 << 30)) / (1 << 30)
    rows = pages.where(place < min(1.0, sample / max(n, 1))).select(F.col("page_id").cast("long").alias("page_id"), "html")
    rows = sorted(rows.limit(2 * sample).collect(), key=lambda r: (r["page_id"] or 0, r["html"] or ""))
    parsed, rng, known = [p for p in (blocks_of(r["html"] or "") for r in rows) if p], np.random.default_rng(1), []
    spare = [b for p in parsed for b in p if not teacher(b)]
    for p in parsed:
        known.append((describe(p), np.array([teacher(b) for b in p], bool)))
        for _ in range(2):
            blocks, want = set_anew(p, spare, rng)
            if blocks:
                known.append((describe(blocks), want))
    return Labeller().fit(known, steps)


def main_text(pages: DataFrame, sample: int = SAMPLE, steps: int = STEPS, model: Labeller | None = None) -> DataFrame:
    """page_id, url, text: the main text of every page, its blocks joined by a line feed.

    A null html is an empty page; pages without main text give ''. Character references are decoded, white space inside
    a block becomes one space. Every block of every page is labelled; repeated rows give equal rows, an empty table none.
    Other columns are not read.
    """
    labeller = model or learn(pages, sample, steps)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(batches, "html"):
            parsed = [blocks_of(h) for h in pdf["html"]]
            labels = labeller.labels([describe(p) for p in parsed])
            texts = ["\n".join(b.text for b, y in zip(p, ys, strict=True) if y) for p, ys in zip(parsed, labels, strict=True)]
            yield pdf[["page_id", "url"]].assign(text=texts)

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInPandas(work, "page_id long, url string, text string")


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
