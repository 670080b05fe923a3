"""Main-text extraction from HTML by a recurrent block labeller (operator 3).

A page becomes its sequence of leaf blocks (runs of text between block
boundaries), each with the tags, classes and ids above it. A bidirectional LSTM
in numpy reads hashed tag-path and word vectors of the whole sequence and
labels every block article or not, so a block is judged in the context of its
page. The model is fitted here: on a bounded sample of pages, labelled by the
markup's own vocabulary (nav, aside, class="comments", ...), with containers
renamed at random so that no single template is learnt by heart.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import unit_hash

# HTML's element classes.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img svg math".split())
# Text without markup in it, up to the closing tag; without that tag they are elements like any other.
RAW = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("title", "textarea", "iframe")}
# What a head may hold; any other element or text opens the body.
IN_HEAD = set("html head title base basefont bgsound link meta noscript script style template".split())
# Controls end with the next block. What a button or template holds goes only if its own closing tag is there.
CONTROLS = {"button", "select", "textarea"}
UNSEEN = {"button", "template"}
# Blocks that end an open svg or math, and the parts of those two that are not prose.
BREAKOUT = set(
    "address article aside blockquote body button center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html "
    "li main menu nav noscript ol p pre section select summary table tbody td th thead tr ul".split()
)
LABELS = {"text", "desc", "metadata", "annotation", "annotation-xml"}

# What the markup itself calls a part of the page. Used to label training blocks only.
ASIDE_TAGS = set("nav header footer aside form fieldset menu dialog button".split())
ASIDE_NAMES = set(
    "ad ads advert advertisement adverts sponsor sponsored promo banner menu nav navbar navigation breadcrumb breadcrumbs sidebar side widget related "
    "share social comment comments reply replies discussion notice notices alert cookie cookies consent gdpr popup modal subscribe newsletter signup "
    "login search footer header masthead topbar copyright legal pagination pager tags form".split()
)
MAIN_TAGS = {"article", "main"}
MAIN_NAMES = set("article content post entry story main text body".split())

# Names that training pages give to their containers.
AS_MAIN = [("article", ""), ("main", ""), ("div", "content"), ("div", "post"), ("section", "article"), ("div", "story"), ("div", "entry content"), ("div", "main")]
AS_ASIDE = [
    ("nav", ""), ("header", ""), ("footer", ""), ("aside", ""), ("form", ""), ("div", "ad"), ("div", "menu"), ("div", "sidebar"), ("div", "comments"), ("section", "comments"),
    ("div", "comment"), ("div", "cookie notice"), ("div", "banner"), ("div", "promo"), ("div", "related"), ("ul", "menu"), ("div", "newsletter"), ("div", "footer"), ("div", "header"),
    ("section", "related"), ("div", "advert"), ("aside", "sidebar"), ("div", "notice"), ("div", "share"), ("div", "nav"), ("div", "widget"), ("div", "popup"), ("ol", "comments"),
]

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style)\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/)?(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)",
    re.S | re.I,
)
ATTR = re.compile(r"\b(class|id|role|hidden|style)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
NAME = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class BlockSpec:
    """Fitted on a bounded sample of about ``sample_pages`` pages of at most ``sample_blocks`` blocks
    and ``sample_chars`` characters each; labelling reads whole pages, ``chunk`` pages and ``span`` blocks
    of each at a time."""

    sample_pages: int = 300
    sample_blocks: int = 60
    sample_chars: int = 60_000
    variants: int = 4
    path_dims: int = 256
    word_dims: int = 128
    hidden: int = 24
    epochs: int = 8
    batch: int = 32
    rate: float = 0.01
    threshold: float = 0.5
    chunk: int = 64
    span: int = 512
    seed: int = 3


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, str], ...]  # (tag, names) from the root down
    linked: int


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks of a whole page in order; broken markup is read as browsers roughly do."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    before: list[tuple[int, int]] = []  # number of blocks and ``foreign`` as each open element began
    parts: list[tuple[str, bool]] = []
    at, page = 0, page or ""
    foreign = -1  # where on the stack the svg or math is that holds this place

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
            if text:
                out.append(Block(text, tuple(stack_at), sum(len(p) for p, linked in parts if linked)))
            parts.clear()

    stack_at: list[tuple[str, str]] = []

    def say(text: str) -> None:
        if text:
            if foreign >= 0 and any(t in LABELS for t, _ in stack[foreign:]):
                return
            if stack and stack[-1][0] == "head" and text.strip():
                cut(len(stack) - 1)
            if not parts:
                stack_at[:] = stack
            elif not parts[0][0].strip() and text.strip():
                stack_at[:] = stack
            parts.append((text, any(t == "a" for t, _ in stack)))

    def cut(k: int) -> None:
        """Close the elements from the k-th on."""
        nonlocal foreign
        foreign = before[k][1]
        del stack[k:], before[k:]

    def end_first(tags: set[str]) -> None:
        for k, (t, _) in enumerate(stack):
            if t in tags:
                cut(k)
                break

    unclosed: set[str] = set()
    while m := TOKEN.search(page, at):
        say(page[at : m.start()])
        at = m.end()
        if m["raw"]:
            if foreign < 0:
                flush()
            continue
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if tag not in INLINE and (foreign < 0 or tag in BREAKOUT):
            flush()
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if tag in UNSEEN:
                        del out[before[k][0] :]
                    cut(k)
                    break
            continue
        closed = m["attrs"].rstrip().endswith("/")
        if tag in RAW:
            end = None if closed or tag in unclosed else RAW[tag].search(page, at)
            if end:
                at = end.end()
            if end or closed:
                continue
            unclosed.add(tag)
        if tag not in IN_HEAD and foreign < 0:
            end_first({"head", "title"})
        if tag in VOID:
            continue
        while foreign >= 0 and tag in BREAKOUT:
            cut(foreign)
        if tag not in INLINE and tag not in ("option", "optgroup") and foreign < 0:
            end_first(CONTROLS)
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    cut(k)
                    break
                if stack[k][0] not in INLINE and stack[k][0] != "p":
                    break
        names = " ".join(v.strip("\"'").lower() for k, v in ATTR.findall(m["attrs"]) if k.lower() in ("class", "id", "role"))
        if not closed or (tag not in INLINE and foreign < 0):
            before.append((len(out), foreign))
            foreign = len(stack) if tag in ("svg", "math") else -1 if tag == "foreignobject" else foreign
            stack.append((tag, names))
    tail = page[at:]
    say(tail[: tail.rfind("<")] if re.search(r"<[a-zA-Z/!][^>]*\Z", tail) else tail)
    flush()
    return [b for b in out if not any(t in ("head", "title", "select") for t, _ in b.path)]


def weak_label(path: tuple[tuple[str, str], ...]) -> int:
    """What the markup's own vocabulary says of a block: 1 article, 0 anything else."""
    names = {w for _, n in path for w in NAME.findall(n)}
    tags = {t for t, _ in path}
    if tags & ASIDE_TAGS or names & ASIDE_NAMES:
        return 0
    if tags & MAIN_TAGS or names & MAIN_NAMES:
        return 1
    return int(bool(tags & set("p h1 h2 h3 h4 h5 h6 blockquote pre li td".split())))


class _Ids(dict):
    """Feature text -> hashed id; cleared when large, so memory stays bounded."""

    def __init__(self, dims: int):
        self.dims = dims

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = i = zlib.crc32(word.encode("utf-8", "replace")) % self.dims
        return i


def _path_features(path: tuple[tuple[str, str], ...]) -> list[str]:
    found = {f"t:{t}" for t, _ in path} | {f"n:{w}" for _, n in path for w in NAME.findall(n)}
    last = [t for t, _ in path if t not in INLINE][-2:]
    return sorted(found | {"l:" + ">".join(last)})


def features(blocks: list[Block], paths: _Ids, words: _Ids, first: int = 0, total: int = 0) -> np.ndarray:
    """One row per block: path marks, word shares and plain numbers. ``first`` and ``total`` place a part of a page in it."""
    n, pd_, wd = len(blocks), paths.dims, words.dims
    x = np.zeros((n, pd_ + wd + PLAIN), np.float32)
    for k, b in enumerate(blocks):
        x[k, [paths[f] for f in _path_features(b.path)]] = 1.0
        found = [words[w] for w in b.text.lower().split()]
        x[k, pd_ : pd_ + wd] = np.bincount(found, minlength=wd) / len(found)
        x[k, pd_ + wd :] = np.log1p(len(b.text)) / 8, b.linked / (1 + len(b.text)), float(b.text[-1] in ".!?"), (first + k) / (total or n)
    return x


PLAIN = 4


def new_weights(spec: BlockSpec) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(spec.seed)
    h, out = spec.hidden, {}
    for d in "fb":  # forward and backward reader: input, recurrent and bias weights
        out |= {
            f"x{d}": rng.normal(0, 0.1, (spec.path_dims + spec.word_dims + PLAIN, 4 * h)),
            f"u{d}": rng.normal(0, 1 / np.sqrt(h), (h, 4 * h)),
            f"c{d}": np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)]),
        }
    return {k: v.astype(np.float32) for k, v in (out | {"o": rng.normal(0, 0.1, (2 * h,)), "z": np.zeros(1)}).items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pages padded to one length, and the mask of their true steps."""
    t = max(map(len, pages))
    x, mask = np.zeros((len(pages), t, pages[0].shape[1]), np.float32), np.zeros((len(pages), t), np.float32)
    for k, p in enumerate(pages):
        x[k, : len(p)], mask[k, : len(p)] = p, 1.0
    return x, mask


def _read(w: dict, x: np.ndarray, mask: np.ndarray, d: str, state: tuple | None = None, keep: bool = False) -> tuple[np.ndarray, list, tuple]:
    """LSTM states of all steps (in page order), the steps' gates if they are kept (for training), and the state after the
    last step read, from which the next part of a page goes on."""
    n, t, _ = x.shape
    h = w[f"u{d}"].shape[0]
    x = x @ w[f"x{d}"] + w[f"c{d}"]
    states, steps = np.zeros((n, t, h), np.float32), []
    hid, cell = state or (np.zeros((n, h), np.float32), np.zeros((n, h), np.float32))
    for s in range(t) if d == "f" else range(t - 1, -1, -1):
        a = x[:, s] + hid @ w[f"u{d}"]
        gates, g = _sigmoid(a[:, : 3 * h]), np.tanh(a[:, 3 * h :])
        i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
        m = mask[:, s : s + 1]
        new = f * cell + i * g
        tc = np.tanh(new)
        if keep:
            steps.append((s, i, f, o, g, tc, hid, cell))
        hid, cell = m * (o * tc) + (1 - m) * hid, m * new + (1 - m) * cell
        states[:, s] = hid
    return states, steps, (hid, cell)


def probabilities(w: dict, pages: list[list[Block]], paths: _Ids, words: _Ids, span: int) -> list[np.ndarray]:
    """Article probability of each page's blocks.

    Pages are read ``span`` blocks at a time, once forward and once backward, and the reader's state is carried from part to
    part: every block still sees the whole page, and memory does not grow with the longest one.
    """
    h, n, t = w["uf"].shape[0], len(pages), max(map(len, pages))
    z = np.full((n, t), w["z"][0], np.float32)
    starts, once = list(range(0, t, span)), {}

    def part(a: int) -> tuple[np.ndarray, np.ndarray]:
        if a not in once:
            once.clear()
            once[a] = _padded([features(p[a : a + span], paths, words, a, len(p)) for p in pages])
        return once[a]

    for k, d in enumerate("fb"):
        state = None
        for a in starts if d == "f" else starts[::-1]:
            x, mask = part(a)
            states, _, state = _read(w, x, mask, d, state)
            z[:, a : a + x.shape[1]] += states @ w["o"][k * h : (k + 1) * h]
    return [_sigmoid(row[: len(p)]) for row, p in zip(z, pages)]


def _gradients(w: dict, x: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean logistic loss, by backpropagation through time."""
    n, t, dims = x.shape
    h = w["uf"].shape[0]
    reads = {d: _read(w, x, mask, d, keep=True) for d in "fb"}
    both = np.concatenate([reads["f"][0], reads["b"][0]], 2)
    err = (_sigmoid(both @ w["o"] + w["z"][0]) - labels) * mask / mask.sum()
    grads = {"o": np.einsum("nt,nth->h", err, both), "z": np.array([err.sum()])}
    for k, d in enumerate("fb"):
        up = err[:, :, None] * w["o"][k * h : (k + 1) * h]
        da = np.zeros((n, t, 4 * h), np.float32)
        du = np.zeros_like(w[f"u{d}"])
        dh, dc = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        for s, i, f, o, g, tc, before, cell in reversed(reads[d][1]):
            m = mask[:, s : s + 1]
            dh = dh + up[:, s]
            live = m * dh
            dn = live * o * (1 - tc**2) + m * dc
            a = np.concatenate([dn * g * i * (1 - i), dn * cell * f * (1 - f), live * tc * o * (1 - o), dn * i * (1 - g**2)], 1)
            da[:, s] = a
            du += before.T @ a
            dh, dc = (1 - m) * dh + a @ w[f"u{d}"].T, (1 - m) * dc + dn * f
        flat = da.reshape(n * t, -1)
        grads[f"u{d}"], grads[f"c{d}"], grads[f"x{d}"] = du, flat.sum(0), x.reshape(n * t, dims).T @ flat
    return grads


def renamed(blocks: list[Block], rng: random.Random) -> list[Block]:
    """The page with every labelled container under another name; some blocks of the article reappear as comments or notes."""
    names: dict = {}
    out = []

    def rename(path):
        new = []
        for k, (tag, name) in enumerate(path):
            own = weak_label(path[: k + 1])
            marks = tag in ASIDE_TAGS | MAIN_TAGS or set(NAME.findall(name)) & (ASIDE_NAMES | MAIN_NAMES)
            new.append(names.setdefault((k, tag, name), rng.choice(AS_MAIN if own else AS_ASIDE)) if marks else (tag, name))
        return tuple(new)

    for b in blocks:
        out.append(Block(b.text, rename(b.path), b.linked))
    root = tuple(x for x in (blocks[0].path if blocks else ()) if x[0] in ("html", "body"))
    article = [b for b in blocks if weak_label(b.path)]
    main = next((x for b in article for x in rename(b.path) if weak_label((x,))), None)
    for _ in range(rng.randint(1, 4)):  # prose that is not the article
        if article:
            inside = root + ((main,) if main and rng.random() < 0.3 else ())
            holder = inside + (rng.choice(AS_ASIDE),) + ((("p", ""),) if rng.random() < 0.7 else ())
            run = [Block(rng.choice(article).text, holder, 0) for _ in range(rng.randint(1, 4))]
            k = rng.choice([0, len(out), rng.randint(0, len(out))])
            out[k:k] = run
    return out


def fit(pages: list[str], spec: BlockSpec = BlockSpec()) -> dict[str, np.ndarray]:
    """Adam over the sample pages and their renamed variants; reproducible for the same pages in the same order."""
    rng = random.Random(spec.seed)
    paths, words = _Ids(spec.path_dims), _Ids(spec.word_dims)
    data = []
    for page in pages:
        blocks = blocks_of(page)
        for v in range(spec.variants + 1):
            these = blocks if v == 0 else renamed(blocks, rng)
            if len(these) > spec.sample_blocks:
                k = rng.choice([0, len(these) - spec.sample_blocks, rng.randint(0, len(these) - spec.sample_blocks)])
                these = these[k : k + spec.sample_blocks]
            if these:
                data.append((features(these, paths, words), [weak_label(b.path) for b in these]))
    w = new_weights(spec)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step = 0
    for _ in range(spec.epochs):
        rng.shuffle(data)
        for k in range(0, len(data), spec.batch):
            part = data[k : k + spec.batch]
            x, mask = _padded([f for f, _ in part])
            y = np.zeros(mask.shape, np.float32)
            for r, (_, labels) in enumerate(part):
                y[r, : len(labels)] = labels
            step += 1
            for key, g in _gradients(w, x, mask, y).items():
                g = np.clip(g, -1, 1)
                first[key] += 0.1 * (g - first[key])
                second[key] += 0.001 * (g * g - second[key])
                w[key] -= spec.rate * (first[key] / (1 - 0.9**step)) / (np.sqrt(second[key] / (1 - 0.999**step)) + 1e-8)
    return w


def main_texts(pages: list[str | None], w: dict[str, np.ndarray], spec: BlockSpec, paths: _Ids, words: _Ids) -> list[str]:
    """Article text of each page: its article blocks, one per line."""
    parsed = [blocks_of(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if parsed[k]), key=lambda k: len(parsed[k]))
    for at in range(0, len(order), spec.chunk):
        group = order[at : at + spec.chunk]
        for k, p in zip(group, probabilities(w, [parsed[k] for k in group], paths, words, spec.span)):
            out[k] = "\n".join(b.text for b, x in zip(parsed[k], p) if x >= spec.threshold)
    return out


def train_labeller(pages: DataFrame, spec: BlockSpec = BlockSpec()) -> dict[str, np.ndarray]:
    """Fit on a hash sample of ``pages`` (column html); without pages the labeller is untrained."""
    known = pages.where(F.length("html") > 0)
    total = known.count()
    rate = min(1.0, spec.sample_pages / max(1, total))
    drawn = known.where(unit_hash(F.col("html"), F.lit(spec.seed)) < rate).select(F.substring("html", 1, spec.sample_chars).alias("html")).distinct().collect()
    return fit(sorted(r["html"] for r in drawn), spec)


def extract_main_text(pages: DataFrame, weights: dict[str, np.ndarray], spec: BlockSpec = BlockSpec()) -> DataFrame:
    """All columns of ``pages`` plus ``text`` (empty if the page has none) and ``n_chars`` (its code points).

    A null or empty page has the empty text. Every row gives one row. Input
    columns with the two names are replaced.
    """
    shared = pages.sparkSession.sparkContext.broadcast(weights)  # fixed size

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        paths, words = _Ids(spec.path_dims), _Ids(spec.word_dims)
        for batch in batches:
            parts = [main_texts(batch.slice(k, 512).to_pylist(), shared.value, spec, paths, words) for k in range(0, len(batch), 512)]
            yield pa.array([t for part in parts for t in part], pa.string())

    keep = [F.col(f"`{c}`") for c in pages.columns if c not in ("text", "n_chars")]
    return pages.select(*keep, extract(F.col("html")).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
