"""Main text of web pages with a recurrent block labeller.

A page is the sequence of its leaf blocks. Each block is a vector of its hashed tag path, its hashed words and a few shares
(length, links, punctuation, place). A bidirectional LSTM in numpy reads the whole sequence, so that every block is judged
with all of the page before and after it, and one probability per block says whether it belongs to the main text.

There are no labelled pages. A teacher marks the blocks of a bounded sample of pages: inside an element that is declared to
hold the article and not inside one declared to be something else (where a page declares nothing: blocks of running text).
The labeller learns from several disguised copies of each page. In a copy the declaring elements get other names or none,
and menus, headers, sidebars, notices, adverts, forms and reader comments made of other pages' blocks are put in; so names,
words, links, place and neighbours all have to be used. Labelling is a scan: pages are not shuffled, no block is capped.

A null page is empty and gives an empty text. Rows that repeat an id are pages of their own. An empty table gives an empty
result. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from wavelattice.llm.common import table
from wavelattice.llm.html_blocks import Block, blocks
from wavelattice.llm.tokens import words

#: Bound of the sample: so many pages (those of the smallest hash) among those of at most so many characters.
SAMPLE_PAGES, SAMPLE_CHARS = 256, 1 << 17
#: Disguised copies per sampled page, blocks of a training sequence (longer pages give several), and passes.
COPIES, WINDOW, EPOCHS, HIDDEN, SEED = 4, 96, 24, 24, 7
PATH_BINS, LEAF_BINS, WORD_BINS, SHARES = 256, 64, 64, 8
WIDTH = PATH_BINS + LEAF_BINS + WORD_BINS + SHARES
#: Blocks that are labelled at a time; a longer page is a group of its own.
GROUP_BLOCKS = 1 << 13

# Words of tags, classes and ids that declare what an element holds.
MAIN_NAMES = frozenset("article main .article .main .content .post .entry .story .body".split())
OTHER_NAMES = frozenset("""nav footer aside form header menu dialog button .ad .ads .advert .advertisement .sponsored .promo .sidebar
    .menu .nav .navbar .navigation .footer .header .masthead .banner .cookie .cookies .consent .notice .alert .popup .modal
    .comment .comments .reply .replies .discussion .disqus .share .social .related .newsletter .subscribe .login .search
    .breadcrumb .breadcrumbs .widget .toolbar .copyright""".split())


# --- vectors

def _bin(name: str, bins: int, salt: str) -> int:
    return zlib.crc32(f"{salt}{name}".encode()) % bins


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Names of the whole path in the first bins, names of its last two elements in the others."""
    v = np.zeros(PATH_BINS + LEAF_BINS, np.float32)
    for name in path:
        v[_bin(name, PATH_BINS, "path ")] = 1.0
    tags = [i for i, n in enumerate(path) if not n.startswith(".")]
    for depth, begin in enumerate(tags[:-3:-1]):
        for name in path[begin:tags[-depth] if depth else len(path)]:
            v[PATH_BINS + _bin(name, LEAF_BINS, f"leaf {depth} ")] = 1.0
    return v


def vectors(pages: Sequence[Sequence[Block]], cache: dict | None = None) -> np.ndarray:
    """One row per block of all pages, in order."""
    flat = [b for page in pages for b in page]
    out = np.zeros((len(flat), WIDTH), np.float32)
    if not flat:
        return out
    cache = {} if cache is None else cache
    if len(cache) > 1 << 14:
        cache.clear()
    for i, b in enumerate(flat):
        v = cache.get(b.path)
        if v is None:
            v = cache[b.path] = path_vector(b.path)
        out[i, :PATH_BINS + LEAF_BINS] = v
    raw = [b.text.encode() for b in flat]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    _, _, of, h = words(np.frombuffer(b"".join(raw), np.uint8), offsets)
    counts = np.bincount(of * WORD_BINS + (h >> np.uint64(58)).astype(np.int64), minlength=len(flat) * WORD_BINS)
    counts = np.log1p(counts.reshape(len(flat), WORD_BINS))
    out[:, PATH_BINS + LEAF_BINS:-SHARES] = counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1.0)
    chars = np.array([len(b.text) for b in flat], np.float32)
    n_words = np.bincount(of, minlength=len(flat))
    sizes = [len(page) for page in pages]
    place = np.concatenate([(np.arange(n) + 0.5) / n for n in sizes if n])
    marks = np.array([sum(map(b.text.count, ".,;:!?")) for b in flat], np.float32)
    out[:, -SHARES:] = np.stack([
        np.log1p(chars) / 8, np.log1p(n_words) / 6, [b.linked / len(b.text) for b in flat], np.minimum(marks / np.maximum(n_words, 1), 1),
        [b.text[-1] in ".!?\"'»”)" for b in flat], place, 1 - place, 1 / np.repeat(sizes, sizes)], axis=1)
    return out


# --- labeller

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Sequences:
    """Rows of several sequences as time steps: at step ``t`` the ``active[t]`` longest sequences have a row."""

    def __init__(self, sizes: Sequence[int]):
        sizes = np.asarray(sizes, np.int64)
        begin = np.cumsum(sizes) - sizes
        self.order = np.argsort(-sizes, kind="stable")
        size, begin = sizes[self.order], begin[self.order]
        steps = int(size[0]) if len(size) else 0
        self.active = np.searchsorted(-size, -np.arange(steps), side="left")
        self.rows = {1: [begin[:n] + t for t, n in enumerate(self.active)],
                     -1: [(begin + size - 1)[:n] - t for t, n in enumerate(self.active)]}


def new_weights(rng: np.random.Generator, hidden: int = HIDDEN, width: int = WIDTH) -> dict[str, np.ndarray]:
    w = {}
    for d in ("f", "b"):
        w[f"x{d}"] = rng.normal(0, 0.1, (width, 4 * hidden)).astype(np.float32)
        w[f"h{d}"] = rng.normal(0, 0.5 / np.sqrt(hidden), (hidden, 4 * hidden)).astype(np.float32)
        w[f"c{d}"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]).astype(np.float32)
    w["out"] = rng.normal(0, 0.1, 2 * hidden).astype(np.float32)
    w["bias"] = np.zeros(1, np.float32)
    return w


def _read(x: np.ndarray, seq: Sequences, w: dict, d: str, keep: list | None = None) -> np.ndarray:
    """Hidden state at every row, reading the sequences forward (``f``) or backward (``b``)."""
    k = w[f"h{d}"].shape[0]
    z = x @ w[f"x{d}"] + w[f"c{d}"]
    out = np.zeros((len(x), k), z.dtype)
    h, c = np.zeros((2, len(seq.order), k), z.dtype)
    for n, rows in zip(seq.active, seq.rows[1 if d == "f" else -1]):
        a = z[rows] + h[:n] @ w[f"h{d}"]
        gates = _sigmoid(a[:, :3 * k])  # in, forget, out
        g = np.tanh(a[:, 3 * k:])
        before_h, before_c = h[:n].copy(), c[:n].copy()
        c[:n] = gates[:, k:2 * k] * before_c + gates[:, :k] * g
        tc = np.tanh(c[:n])
        h[:n] = gates[:, 2 * k:] * tc
        out[rows] = h[:n]
        if keep is not None:
            keep.append((rows, gates, g, tc, before_h, before_c))
    return out


def probabilities(x: np.ndarray, sizes: Sequence[int], w: dict) -> np.ndarray:
    """Probability of main text for every row of sequences of the given sizes."""
    if not len(x):
        return np.zeros(0, np.float32)
    seq = Sequences(sizes)
    return _sigmoid(np.hstack([_read(x, seq, w, "f"), _read(x, seq, w, "b")]) @ w["out"] + w["bias"])


def loss_and_gradient(x: np.ndarray, sizes: Sequence[int], y: np.ndarray, weight: np.ndarray, w: dict) -> tuple[float, dict]:
    """Weighted mean cross-entropy and its gradient by back-propagation through time."""
    seq, k = Sequences(sizes), w["hf"].shape[0]
    kept = {"f": [], "b": []}
    states = np.hstack([_read(x, seq, w, d, kept[d]) for d in ("f", "b")])
    p = _sigmoid(states @ w["out"] + w["bias"])
    share = weight / weight.sum()
    tiny = 1e-7
    loss = -float(share @ (y * np.log(p + tiny) + (1 - y) * np.log(1 - p + tiny)))
    dz = ((p - y) * share).astype(x.dtype)
    grad = {"out": states.T @ dz, "bias": dz.sum(keepdims=True)}
    for j, d in enumerate(("f", "b")):
        above = dz[:, None] * w["out"][j * k:(j + 1) * k]
        da = np.zeros((len(x), 4 * k), x.dtype)
        dh, dc = np.zeros((2, len(seq.order), k), x.dtype)
        gh = np.zeros_like(w[f"h{d}"])
        for rows, gates, g, tc, before_h, before_c in reversed(kept[d]):
            n = len(rows)
            i, f, o = gates[:, :k], gates[:, k:2 * k], gates[:, 2 * k:]
            top = above[rows] + dh[:n]
            cell = dc[:n] + top * o * (1 - tc * tc)
            step = np.hstack([cell * g * i * (1 - i), cell * before_c * f * (1 - f), top * tc * o * (1 - o), cell * i * (1 - g * g)])
            da[rows] = step
            gh += before_h.T @ step
            dh[:n], dc[:n] = step @ w[f"h{d}"].T, cell * f
        grad[f"x{d}"], grad[f"h{d}"], grad[f"c{d}"] = x.T @ da, gh, da.sum(axis=0)
    return loss, grad


# --- teacher and disguises

def _elements(path: tuple[str, ...]) -> list[tuple[str, ...]]:
    tags = [i for i, n in enumerate(path) if not n.startswith(".")]
    return [path[a:b] for a, b in zip(tags, [*tags[1:], len(path)])]


def taught(page: Sequence[Block]) -> tuple[np.ndarray, float]:
    """Labels of the blocks of a page, and how far they count."""
    declared = np.zeros(len(page), bool)
    main = False
    for i, b in enumerate(page):
        says = None  # what the innermost element that declares anything declares; other names prevail within an element
        for element in _elements(b.path):
            if any(n in OTHER_NAMES for n in element):
                says = False
            elif any(n in MAIN_NAMES for n in element):
                says = True
                main = True
        declared[i] = bool(says)
    if main:
        return declared.astype(np.float32), 1.0
    running = [len(b.text.split()) >= 8 and b.linked * 3 < len(b.text) and not any(n in OTHER_NAMES for n in b.path) for b in page]
    return np.array(running, np.float32), 0.2


# How disguised copies name elements, and the kinds of other elements that are put in.
_CONTAINERS = (("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post"), ("div", ".entry", ".content"),
               ("section", ".story"), ("div", ".article", ".body"), ("section",), ("div",), ("td",))
_OTHERS = {
    "menu": (("nav",), ("nav", "ul"), ("div", ".menu"), ("div", ".nav", ".navbar"), ("header", "nav"), ("div", ".navigation"), ("menu",)),
    "header": (("header",), ("div", ".header"), ("div", ".masthead"), ("header", "div", ".banner")),
    "footer": (("footer",), ("div", ".footer"), ("div", ".copyright"), ("footer", "div"), ("section", ".footer")),
    "sidebar": (("aside",), ("div", ".sidebar"), ("aside", ".sidebar", "section"), ("div", ".widget"), ("div", ".related"), ("section", ".newsletter")),
    "notice": (("div", ".cookie", ".notice"), ("div", ".consent"), ("div", ".alert"), ("div", ".notice"), ("dialog",), ("div", ".popup"),
               ("div", ".modal"), ("section", ".cookies")),
    "advert": (("div", ".ad"), ("div", ".ads"), ("div", ".advert"), ("div", ".sponsored"), ("aside", ".ad"), ("div", ".promo"),
               ("div", ".advertisement"), ("section", ".sponsored")),
    "form": (("form",), ("form", "fieldset"), ("form", "div"), ("div", ".login", "form"), ("form", ".search")),
    "comments": (("div", ".comments"), ("section", ".comments"), ("ol", ".comments", "li", ".comment"), ("div", ".discussion"),
                 ("div", ".comment"), ("section", ".comments", "article", ".comment"), ("div", ".replies"), ("ul", ".comment", ".list", "li")),
}
_ENDINGS = {"menu": (("ul", "li", "a"), ("ul", "li"), ("a",), ("li",)), "header": (("h1",), ("p",), ("div",), ("h2",)),
            "footer": ((), ("p",), ("div",), ("ul", "li", "a")), "sidebar": (("p",), ("ul", "li", "a"), ("h3",), ("div",)),
            "notice": ((), ("p",), ("div",), ("span",)), "advert": ((), ("p",), ("a",), ("div",)), "form": (("p",), ("label",), ("div",), ()),
            "comments": (("p",), ("div",), ("p",), ("blockquote", "p"))}
_KIND_OF = {"nav": "menu", "footer": "footer", "header": "header", "aside": "sidebar", "form": "form", ".ad": "advert"}
_ROOTS = (("html", "body"), ("html", "body", "div"), ("html", "body", "div", ".page", "div"), ("html", "body", "table", "tr", "td"))


def _pick(rng, items):
    return items[int(rng.integers(len(items)))]


def disguised(page: Sequence[Block], labels: np.ndarray, others: Sequence[Sequence[Block]], rng: np.random.Generator
              ) -> tuple[list[Block], np.ndarray]:
    """A copy of a page with renamed elements and inserted parts made of blocks of other pages."""
    root, container, renamed = _pick(rng, _ROOTS), _pick(rng, _CONTAINERS), {}
    rename = rng.random() < 0.75
    rows: list[tuple[Block, float]] = []
    for b, y in zip(page, labels):
        path = b.path
        if rename:
            j = next((i for i, n in enumerate(path) if n in MAIN_NAMES or n in _KIND_OF), None)
            if j is not None:
                kind = _KIND_OF.get(path[j])
                tag = j if not path[j].startswith(".") else max(i for i in range(j) if not path[i].startswith("."))
                new = container if kind is None else renamed.setdefault(kind, _pick(rng, _OTHERS[kind]))
                path = (*root, *new, *path[j + 1:]) if tag <= j else path
        rows.append((Block(path, b.text, b.linked), float(y)))
    mine = [i for i, (_, y) in enumerate(rows) if y]
    first, last = (mine[0], mine[-1] + 1) if mine else (0, len(rows))

    def part(kind: str, inside: tuple[str, ...] = ()) -> list[tuple[Block, float]]:
        start, ending = (*(inside or root), *_pick(rng, _OTHERS[kind])), _pick(rng, _ENDINGS[kind])
        source = _pick(rng, others)
        if not source:
            return []
        texts = [b.text for b in source] if kind in ("comments", "sidebar", "notice", "advert") else [
            " ".join(b.text.split()[:int(rng.integers(1, 6))]) for b in source]
        begin = int(rng.integers(len(texts)))
        texts = texts[begin:begin + int(rng.integers(1, 7))]
        return [(Block((*start, *ending), t, len(t) if "a" in ending else 0), 0.0) for t in texts if t]

    inner = rows[first][0].path[:len(root) + len(container)] if mine and rename else ()
    after = [k for k in ("comments", "sidebar", "form", "footer", "notice", "menu") if rng.random() < 0.3]
    before = [k for k in ("notice", "header", "menu", "sidebar", "form", "advert") if rng.random() < 0.25]
    rng.shuffle(after)
    rng.shuffle(before)
    middle = []
    for i in range(first, last):
        middle.append(rows[i])
        if rng.random() < 0.03:
            middle += part("advert", inner)
    if rng.random() < 0.15:
        middle += part("comments", inner)
    joined = ([r for k in before for r in part(k)] + rows[:first] + middle
              + [r for k in after for r in part(k)] + rows[last:])
    return [b for b, _ in joined], np.array([y for _, y in joined], np.float32)


def fit(pages: Sequence[str], copies: int = COPIES, epochs: int = EPOCHS, hidden: int = HIDDEN, seed: int = SEED) -> dict[str, np.ndarray]:
    """Weights of the labeller from a bounded list of pages; no page with text gives weights that know nothing."""
    rng = np.random.default_rng(seed)
    parsed = [p for p in map(blocks, pages) if p]
    weights = new_weights(rng, hidden)
    sequences = []
    for page in parsed:
        labels, counts = taught(page)
        for c in range(copies):
            b, y = disguised(page, labels, parsed, rng) if c else (list(page), labels)
            x = vectors([b])
            for at in range(0, len(b), WINDOW):
                sequences.append((x[at:at + WINDOW], y[at:at + WINDOW], counts))
    if not sequences:
        return weights
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
    step, batch = 0, 32
    rounds = epochs * -(-len(sequences) // batch)
    for _ in range(epochs):
        # sequences of similar length go together; the groups come in random order
        order = sorted(rng.permutation(len(sequences)), key=lambda i: len(sequences[i][0]) // 8)
        groups = [order[i:i + batch] for i in range(0, len(order), batch)]
        for g in rng.permutation(len(groups)):
            chosen = [sequences[i] for i in groups[g]]
            x, y = np.concatenate([s[0] for s in chosen]), np.concatenate([s[1] for s in chosen])
            drop = rng.random(x.shape[0]) < 0.08
            x[np.ix_(drop, np.arange(PATH_BINS + LEAF_BINS))] = 0.0  # now and then the path is unknown
            counts = np.concatenate([np.full(len(s[0]), s[2], np.float32) for s in chosen])
            _, grad = loss_and_gradient(x, [len(s[0]) for s in chosen], y, counts, weights)
            norm = np.sqrt(sum(float((v * v).sum()) for v in grad.values()))
            step += 1
            rate = 0.01 * min(1.0, 1.2 * (1 - step / (rounds + 1)))
            for k, v in grad.items():
                v = v / max(1.0, norm)
                m, s = moments[k]
                m += 0.1 * (v - m)
                s += 0.001 * (v * v - s)
                weights[k] -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return weights


# --- on Spark

def train(pages: DataFrame, key: str = "page_id", html: str = "html", sample: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS,
          **options) -> dict[str, np.ndarray]:
    """Weights fitted in one task on the ``sample`` pages of the smallest hash among those of at most ``chars`` characters."""
    names = sorted(new_weights(np.random.default_rng(0), 1))

    def run(batches):
        sampled = sorted(t for b in batches for t in b.column(0).to_pylist())
        w = fit(sampled, **options)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array([list(w[n].shape) for n in names], pa.list_(pa.int64())), pa.array([w[n].astype("<f4").tobytes() for n in names])],
            names=["name", "shape", "data"])

    chosen = pages.where(F.length(html).between(1, chars)).select(F.col(html).alias("_html"), F.xxhash64(key, html).alias("_h"))
    chosen = chosen.orderBy("_h", "_html").limit(sample).select("_html").coalesce(1)
    rows = chosen.mapInArrow(run, "name string, shape array<bigint>, data binary").collect()
    if not rows:  # no page was sampled, so there was no task
        return fit([], **options)
    return {r["name"]: np.frombuffer(r["data"], "<f4").reshape(r["shape"]).copy() for r in rows}


def _grouped(batches: Iterator[pa.RecordBatch], html: int) -> Iterator[tuple[pa.RecordBatch, list[list[Block]]]]:
    """Slices of batches with the blocks of their pages, about ``GROUP_BLOCKS`` together or one page."""
    for batch in batches:
        begin, held, count = 0, [], 0
        for i in range(batch.num_rows):
            page = blocks(batch.column(html)[i].as_py())
            if held and count + len(page) > GROUP_BLOCKS:
                yield batch.slice(begin, i - begin), held
                begin, held, count = i, [], 0
            held.append(page)
            count += len(page)
        if held:
            yield batch.slice(begin), held


def labelled_blocks(pages: DataFrame, weights: dict, keys: Sequence[str], html: str = "html") -> DataFrame:
    """``<keys>, place, path, text, score`` of every block, in page order by ``place``."""
    def run(batches):
        cache = {}
        for batch, parsed in _grouped(batches, len(keys)):
            sizes = [len(p) for p in parsed]
            score = probabilities(vectors(parsed, cache), sizes, weights)
            flat = [b for p in parsed for b in p]
            of = pa.array(np.repeat(np.arange(len(parsed)), sizes))
            place = np.concatenate([np.arange(n) for n in sizes]) if sizes else []
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(of) for i in range(len(keys))), pa.array(place, pa.int32()), pa.array([" ".join(b.path) for b in flat], pa.string()),
                 pa.array([b.text for b in flat], pa.string()), pa.array(score, pa.float64())], names=[*keys, "place", "path", "text", "score"])

    src = pages.select(*keys, html)
    kinds = ", ".join(f"`{k}` {src.schema[k].dataType.simpleString()}" for k in keys)
    return src.mapInArrow(run, f"{kinds}, place int, path string, text string, score double")


def main_text(pages: DataFrame, weights: dict, keys: Sequence[str], html: str = "html") -> DataFrame:
    """``<keys>, text, n_chars``: the blocks of main text of every page, a line each."""
    def run(batches):
        cache = {}
        for batch, parsed in _grouped(batches, len(keys)):
            sizes = [len(p) for p in parsed]
            ends = np.cumsum([0, *sizes])
            chosen = probabilities(vectors(parsed, cache), sizes, weights) >= 0.5
            texts = ["\n".join(b.text for b, c in zip(p, chosen[at:]) if c) for p, at in zip(parsed, ends)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keys))), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=[*keys, "text", "n_chars"])

    src = pages.select(*keys, html)
    schema = pa.schema([(k, to_arrow_type(src.schema[k].dataType)) for k in keys])
    kinds = ", ".join(f"`{k}` {src.schema[k].dataType.simpleString()}" for k in schema.names)
    return src.mapInArrow(run, f"{kinds}, text string, n_chars bigint")


def query(spark, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return main_text(pages, train(pages), ["page_id", "url"])


#: What the pages of the given tables declare as their article, without any learning.
SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS h FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(h, '</?(p|h1)>', chr(1), 'g'), '<br>', ' ', 'g'), '</?b>', '', 'g') AS h FROM a),
e AS (SELECT page_id, url, [regexp_replace(trim(regexp_replace(replace(replace(replace(regexp_replace(x, '&quot;?', '"', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')), '&amp$', '&') FOR x IN string_split(h, chr(1))] AS lines FROM b),
t AS (SELECT page_id, url, array_to_string([x FOR x IN lines IF x <> ''], chr(10)) AS text FROM e)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t
"""
