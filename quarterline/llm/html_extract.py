"""Main-text extraction by a recurrent block labeller.

A page becomes its sequence of leaf blocks.  Each block has a tag-path vector
(hashed names of its elements, with their classes, ids and roles), a hashed
word vector and a few shape figures.  A bidirectional LSTM in numpy reads the
whole sequence and gives every block a probability of being main text from
the context of the entire page.

The labeller is trained when the query runs, on at most ``train_pages`` pages
chosen by a hash of the id.  Their blocks are labelled by what their markup
says (``nav``, ``footer``, ``aside``, ``class="ad"`` ... against ``article``
and ``main``), and the same texts are rendered again in other layouts, with
other names, without names, and with sidebars, notices, forms and reader
comments, so the labeller has to use structure and context too.

Defined results: a NULL or empty page has an empty text; a page without
markup is one block; repeated rows give the same text; nothing is cut.
"""

from __future__ import annotations

import html
import math
import random
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.html_blocks import HEADINGS, Block, blocks

# Names that markup uses for what is not, and what is, the article.
OUTSIDE = frozenset(
    "nav navbar navigation menu header masthead footer foot aside sidebar side ad ads advert adverts advertisement "
    "advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notification alert popup "
    "modal newsletter subscribe subscription signup login search form button comment comments commentlist respond reply "
    "disqus related recommended share sharing social breadcrumb breadcrumbs pagination pager copyright legal widget "
    "toolbar tags skip".split())
INSIDE = frozenset("article main content post entry story body text articlebody".split())

PATH_DIM, WORD_DIM, SHAPE_DIM, HIDDEN = 48, 24, 9, 20
INPUT = PATH_DIM + WORD_DIM + SHAPE_DIM
TRAIN_PAGES = 160
CROP = 60  # training reads this many blocks of a page from its start and its end; labelling reads all


class Labeller(NamedTuple):
    forward: tuple[np.ndarray, np.ndarray]  # (INPUT + HIDDEN + 1, 4 HIDDEN)
    backward: tuple[np.ndarray, np.ndarray]
    out: np.ndarray  # (2 HIDDEN + 1)


class _Codes(dict):
    """word -> 2 * slot + sign bit; a bounded table."""

    def __init__(self, dim: int):
        self.dim = dim

    def __missing__(self, word: str) -> int:
        h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        code = h % self.dim * 2 + (h >> 16 & 1)
        if len(self) < 200_000:
            self[word] = code
        return code


_word_codes = _Codes(WORD_DIM)
_name_codes = _Codes(PATH_DIM - 4)
_paths: dict[tuple[str, ...], np.ndarray] = {}


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    found = _paths.get(path)
    if found is None:
        names = set(path)
        found = np.zeros(PATH_DIM, np.float32)
        for name in names:
            code = _name_codes[name]
            found[code >> 1] += 1 - 2 * (code & 1)
        found[-4:] = (bool(names & OUTSIDE), bool(names & INSIDE), bool(path) and path[-1] in HEADINGS, "li" in names)
        if len(_paths) < 50_000:
            _paths[path] = found
    return found


def vectors(page: list[Block]) -> np.ndarray:
    """(blocks x INPUT)."""
    n = len(page)
    x = np.zeros((n, INPUT), dtype=np.float32)
    if not n:
        return x
    codes: list[int] = []
    counts, shapes = [], []
    for i, b in enumerate(page):
        text = b.text
        words = text.lower().split(" ")
        codes.extend(map(_word_codes.__getitem__, words))
        counts.append(len(words))
        size = len(text)
        shapes.append((math.log1p(size) / 6, size < 40, size > 200, b.linked, text[-1:] in ".!?…\"”",
                       text.count(",") / (1 + size / 60), i / n, i == 0, i == n - 1))
        x[i, :PATH_DIM] = _path_vector(b.path)
    width = 2 * WORD_DIM
    cell = np.repeat(np.arange(n) * width, counts) + np.array(codes)
    bag = np.bincount(cell, minlength=n * width).reshape(n, WORD_DIM, 2)
    x[:, PATH_DIM:PATH_DIM + WORD_DIM] = (bag[:, :, 0] - bag[:, :, 1]) / (2 * np.sqrt(np.array(counts))[:, None])
    x[:, PATH_DIM + WORD_DIM:] = shapes
    return x


def _pass(x: np.ndarray, mask: np.ndarray, weights: tuple[np.ndarray, np.ndarray], keep: list | None = None) -> np.ndarray:
    """One LSTM direction over (pages, steps, INPUT); masked steps carry the state on."""
    wx, wh = weights
    pages, steps, _ = x.shape
    h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    out = np.zeros((pages, steps, HIDDEN), np.float32)
    drive = x @ wx[:-1] + wx[-1]
    for t in range(steps):
        z = drive[:, t] + h @ wh
        gates = 1 / (1 + np.exp(-np.clip(z[:, :3 * HIDDEN], -30, 30)))
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        m = mask[:, t, None]
        new = f * c + i * g
        squashed = np.tanh(new)
        if keep is not None:
            keep.append((h, c, i, f, o, g, squashed, m))
        c = np.where(m, new, c)
        h = np.where(m, o * squashed, h)
        out[:, t] = h
    return out


def _back(x: np.ndarray, d_out: np.ndarray, weights: tuple[np.ndarray, np.ndarray], kept: list) -> tuple[np.ndarray, np.ndarray]:
    wx, wh = weights
    gx, gh = np.zeros_like(wx), np.zeros_like(wh)
    dh, dc = np.zeros_like(kept[0][0]), np.zeros_like(kept[0][0])
    for t in range(x.shape[1] - 1, -1, -1):
        h, c, i, f, o, g, squashed, m = kept[t]
        dh = dh + d_out[:, t]
        through = np.where(m, dh, 0)
        dnew = np.where(m, dc, 0) + through * o * (1 - squashed ** 2)
        dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), through * squashed * o * (1 - o),
                             dnew * i * (1 - g ** 2)], axis=1)
        gx[:-1] += x[:, t].T @ dz
        gx[-1] += dz.sum(axis=0)
        gh += h.T @ dz
        dh = np.where(m, dz @ wh.T, dh)
        dc = np.where(m, dnew * f, dc)
    return gx, gh


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((len(pages), steps, INPUT), np.float32)
    mask = np.zeros((len(pages), steps), bool)
    for i, p in enumerate(pages):
        x[i, :len(p)] = p
        mask[i, :len(p)] = True
    return x, mask


def probabilities(model: Labeller, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Probability of main text for every block of every page; pages of like length run together."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if len(pages[i])]
    for lo in range(0, len(order), 64):
        some = order[lo:lo + 64]
        x, mask = _padded([pages[i] for i in some])
        ahead = _pass(x, mask, model.forward)
        behind = _pass(x[:, ::-1], mask[:, ::-1], model.backward)[:, ::-1]
        z = ahead @ model.out[:HIDDEN] + behind @ model.out[HIDDEN:-1] + model.out[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        for j, i in enumerate(some):
            out[i] = p[j, :len(pages[i])]
    return out


def markup_labels(page: list[Block]) -> np.ndarray:
    """Main text (1), other (0) or unknown (-1) by what the markup says."""
    y = np.full(len(page), -1)
    marked = any(set(b.path) & {"article", "main"} for b in page)
    for i, b in enumerate(page):
        names = set(b.path)
        if names & OUTSIDE:
            y[i] = 0
        elif names & {"article", "main"}:
            y[i] = 1
        elif marked:
            y[i] = 0
    return y


def _rendered(texts: list[str], short: list[str], long: list[str], rng: random.Random) -> str:
    """A page with the given article in a random layout; everything else is made from ``short`` and ``long`` texts."""
    esc = html.escape
    pick = lambda pool, lo, hi: [esc(rng.choice(pool)) for _ in range(rng.randint(lo, hi))]
    name = lambda *choices: rng.choice([f' class="{rng.choice(choices)}"', f' id="{rng.choice(choices)}"'])
    plain = rng.random() < 0.25  # without telling names
    att = lambda *choices: "" if plain else name(*choices)

    def links(lo: int, hi: int) -> str:
        items = pick(short, lo, hi)
        return rng.choice([
            lambda: "<ul>" + "".join(f'<li><a href="/{i}">{t}</a></li>' for i, t in enumerate(items)) + "</ul>",
            lambda: "<div>" + " | ".join(f'<a href="/{i}">{t}</a>' for i, t in enumerate(items)) + "</div>",
            lambda: "".join(f'<div><a href="/{i}">{t}</a></div>' for i, t in enumerate(items))])()

    paragraph = rng.choice(["p", "p", "p", "div"])
    body = []
    for i, t in enumerate(texts):
        t = esc(t)
        kind = rng.random()
        if kind < 0.05:
            body.append(f"<blockquote><p>{t}</p></blockquote>")
        elif kind < 0.1:
            body.append(f"<ul><li>{t}</li></ul>")
        elif kind < 0.15:
            body.append(f"<table><tr><td>{t}</td></tr></table>")
        elif kind < 0.2:
            body.append(f"<h2>{t[:50]}</h2>" if len(t) < 120 else f"<pre>{t}</pre>")
        else:
            body.append(f"<{paragraph}>{t}</{paragraph}>")
    title = f"<h1>{esc(texts[0][:60])}</h1>" if rng.random() < 0.7 else ""
    inner = title + "".join(body)
    mark = "data-main"  # not an attribute the block reader looks at; labels come from the path of this element
    wrap = rng.choice([("article", ""), ("main", ""), ("div", name("content", "post", "entry-content", "article-body", "story", "main")),
                       ("div", ""), ("section", name("post", "article", "content")), ("td", ""), ("section", "")])
    main = f"<{wrap[0]}{wrap[1]} {mark} class=qmainq>{inner}</{wrap[0]}>" if not wrap[1] else \
        f"<{wrap[0]}{wrap[1]} {mark}><div class=qmainq>{inner}</div></{wrap[0]}>"
    if wrap[0] == "td":
        main = f"<table><tr>{main}</tr></table>"

    before = [lambda: ("<nav>" if not plain else "<div>") + links(3, 9) + ("</nav>" if not plain else "</div>"),
              lambda: f"<header><h1>{pick(short, 1, 1)[0]}</h1><p>{rng.choice(pick(short + long, 1, 1))}</p></header>",
              lambda: f"<div{att('menu', 'navbar', 'nav', 'top-menu')}>{links(3, 9)}</div>",
              lambda: f"<div{name('cookie-notice', 'cookie', 'notice', 'consent', 'alert', 'banner')}><p>{esc(rng.choice(long))}</p><button>OK</button></div>",
              lambda: f"<div{name('ad', 'ads', 'advert', 'sponsored', 'ad-slot', 'promo')}>{esc(rng.choice(long + short))}</div>",
              lambda: f"<form action=/s><label>{pick(short, 1, 1)[0]}</label><input name=q><button>{pick(short, 1, 1)[0]}</button></form>",
              lambda: f"<aside>{links(2, 6)}<p>{esc(rng.choice(long))}</p></aside>",
              lambda: f"<div{name('sidebar', 'side', 'widget')}><h3>{pick(short, 1, 1)[0]}</h3>{links(2, 6)}<p>{esc(rng.choice(long))}</p></div>"]
    after = [lambda: f"<footer><p>{esc(rng.choice(long + short))}</p>{links(1, 5)}</footer>",
             lambda: f"<footer>&copy; {pick(short, 1, 1)[0]} {esc(rng.choice(long))}</footer>",
             lambda: f"<div{name('footer', 'copyright', 'legal')}>&copy; {esc(rng.choice(long))}</div>",
             lambda: f"<section{name('comments', 'comment-list', 'comments', 'respond')}><h3>{pick(short, 1, 1)[0]}</h3>"
                     + "".join(f"<div{name('comment', 'comment')}><b>{pick(short, 1, 1)[0]}</b><p>{esc(rng.choice(long))}</p></div>"
                               for _ in range(rng.randint(1, 4))) + "</section>",
             lambda: f"<ol{name('comments', 'commentlist')}>" + "".join(f"<li><p>{t}</p></li>" for t in pick(long, 1, 4)) + "</ol>",
             lambda: f"<div{name('related', 'share', 'recommended', 'newsletter', 'subscribe')}><h4>{pick(short, 1, 1)[0]}</h4>{links(2, 6)}</div>",
             *before[3:]]
    top = "".join(rng.choice(before)() for _ in range(rng.randint(0, 4)))
    bottom = "".join(rng.choice(after)() for _ in range(rng.randint(0, 4)))
    inside = ""
    if rng.random() < 0.3:  # an advert or a share bar in the middle of the article
        inside = rng.choice([before[4], after[5]])()
        main = main.replace("</p><p>", f"</p>{inside}<p>", 1)
    return f"<html><head><title>x</title></head><body>{top}{main}{bottom}</body></html>"


def _examples(pages: list[str], copies: int, rng: random.Random) -> list[tuple[np.ndarray, np.ndarray]]:
    out: list[tuple[np.ndarray, np.ndarray]] = []
    articles, short, long = [], ["Home", "About", "Contact", "Menu", "Read more"], []
    for page in pages:
        found = blocks(page)
        y = markup_labels(found)
        if len(found) and (y >= 0).all() and (y == 1).any():
            out.append((found, y))
        texts = [b.text for b, l in zip(found, y) if l == 1][:CROP]
        if texts:
            articles.append(texts)
        for b in found:
            (short if len(b.text) < 30 else long).append(b.text[:400])
    long = long or short
    rendered = []
    for texts in articles * copies:
        found = blocks(_rendered(texts, short, long, rng))
        # inside the marked element, less the parts whose own names say otherwise
        y = []
        for b in found:
            at = b.path.index("qmainq") if "qmainq" in b.path else -1
            y.append(int(at >= 0 and not set(b.path[at:]) & OUTSIDE))
        rendered.append(([Block(b.text, tuple(n for n in b.path if n != "qmainq"), b.linked) for b in found], np.array(y)))
    rendered += [([Block(" ".join(t), (), 0.0)], np.array([1])) for t in articles[:20]]
    kept = []
    for found, y in out + rendered:
        x = vectors(found)
        if len(found) > 2 * CROP:
            ends = np.r_[0:CROP, len(found) - CROP:len(found)]
            x, y = x[ends], y[ends]
        kept.append((x, y))
    return kept


def train(pages: list[str], copies: int = 5, rounds: int = 10, seed: int = 7) -> Labeller:
    """Fits the labeller to the sampled pages; the same pages give the same labeller."""
    rng = random.Random(seed)
    start = np.random.default_rng(seed)
    draw = lambda *s: (start.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    params = [draw(INPUT + 1, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN), draw(INPUT + 1, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN),
              draw(2 * HIDDEN + 1) * 0.1]
    for w in (params[0], params[2]):
        w[-1] = 0
        w[-1, HIDDEN:2 * HIDDEN] = 1  # remember at first
    data = _examples(pages, copies, rng)
    if not data:
        return Labeller((params[0], params[1]), (params[2], params[3]), params[4])
    data.sort(key=lambda d: len(d[1]))
    groups = [data[i:i + 32] for i in range(0, len(data), 32)]
    mean = [np.zeros_like(p) for p in params]
    square = [np.zeros_like(p) for p in params]
    step = 0
    for r in range(rounds):
        rng.shuffle(groups)
        rate = 0.01 if r < rounds * 0.6 else 0.003
        for group in groups:
            x, mask = _padded([d[0] for d in group])
            y = np.zeros(mask.shape, np.float32)
            for i, d in enumerate(group):
                y[i, :len(d[1])] = d[1]
            kept_a: list = []
            kept_b: list = []
            ahead = _pass(x, mask, (params[0], params[1]), kept_a)
            behind = _pass(x[:, ::-1], mask[:, ::-1], (params[2], params[3]), kept_b)[:, ::-1]
            both = np.concatenate([ahead, behind, np.ones((*mask.shape, 1), np.float32)], axis=2)
            p = 1 / (1 + np.exp(-np.clip(both @ params[4], -30, 30)))
            dz = np.where(mask, p - y, 0).astype(np.float32) / mask.sum()
            d_both = dz[..., None] * params[4]
            grads = [*_back(x, d_both[..., :HIDDEN], (params[0], params[1]), kept_a),
                     *_back(x[:, ::-1], d_both[:, ::-1, HIDDEN:-1], (params[2], params[3]), kept_b),
                     np.einsum("pt,pth->h", dz, both)]
            norm = np.sqrt(sum(float((g ** 2).sum()) for g in grads))
            step += 1
            for k, g in enumerate(grads):
                g = g * min(1.0, 1.0 / max(norm, 1e-9))
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                params[k] -= (rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return Labeller((params[0], params[1]), (params[2], params[3]), params[4])


def main_texts(model: Labeller, pages: list[str | None]) -> list[str]:
    found = [blocks(p) if p else [] for p in pages]
    marks = probabilities(model, [vectors(f) for f in found])
    return ["\n".join(b.text for b, p in zip(f, m) if p >= 0.5) for f, m in zip(found, marks)]


def sampled(pages: DataFrame, html_col: str, id_col: str, train_pages: int) -> list[str]:
    """At most ``train_pages`` pages under 100 kB for training, by the order of a hash."""
    small = pages.filter(F.length(html_col).between(1, 100_000))
    total = small.count()
    share = min(1.0, 3 * train_pages / max(1, total))
    rows = (small.select(id_col, F.col(html_col).alias("h"), F.xxhash64(F.col(id_col), F.lit("train")).alias("k"))
            .filter(F.pmod("k", F.lit(1_000_000)) < int(share * 1_000_000) + 1)
            .orderBy("k", F.xxhash64("h")).limit(train_pages).select("h"))
    return [r["h"] for r in rows.collect()]  # bounded by train_pages


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            train_pages: int = TRAIN_PAGES) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages``."""
    model = train(sampled(pages, html_col, id_col, train_pages))
    shared = pages.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = main_texts(shared.value, part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
            .mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long"))
