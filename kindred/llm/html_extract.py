"""Main text of web pages by a tree-structured graphical model over their DOM.

Every element and every run of text with something to read is a node that is main text or not. A node
weighs for itself (its tag, the words of its class and id, length, links, punctuation, place), a pair of
parent and child by how far they agree. On a tree, messages passed up to the root and down again give the
exact marginals, for all pages of a block at once, level by level. Weights are trained on labelled pages by
the exact gradient of the likelihood, which comes from the same messages.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from kindred.llm.buffers import add_columns
from kindred.llm.dom import INLINE, TEXT, Tree, joined, parse
from kindred.llm.page_layouts import MARK, labelled_pages

# Elements that have weights of their own; all others share one.
TAGS = (
    "#text html body main article section header footer nav aside div p span a b strong i em h1 h2 h3 h4 h5 h6 ul ol li dl dt "
    "dd table tr td th thead tbody blockquote pre code figure figcaption form label button fieldset time small ins center font "
    "address details summary cite"
).split()
_TAG = {name: i + 1 for i, name in enumerate(TAGS)}
_INLINE = np.array([False, *[t in INLINE for t in TAGS]])
PUNCTUATION = ".,;:!?"
BLOCK_CHARS = 1 << 20
# Upper edges of the steps in which a node's figures are read.
LINKS = (0.0, 0.2, 0.5, 0.95)
STOPS = (0.0, 0.03, 0.08, 0.15)
WORDS = (2, 5, 11, 24)
SHARES = (0.005, 0.02, 0.1, 0.3, 0.6, 0.9)
PLACES = (0.02, 0.1, 0.9, 0.98)
SIZES = 12
_COLUMNS = (SIZES, len(LINKS) + 1, len(STOPS) + 1, len(WORDS) + 1, len(SHARES) + 1, len(PLACES) + 1, len(TAGS) + 1, len(TAGS) + 1)
_OFFSETS = np.cumsum([0, *[2 * n for n in _COLUMNS]])  # text nodes and elements have weights of their own


@dataclass
class Forest:
    """The trees of several pages in one set of arrays. ``own`` are the numbers of a node's features,
    ``hint`` pairs of a node and a word; levels list the nodes of equal depth, parents first."""

    parent: np.ndarray
    levels: list[np.ndarray]
    own: np.ndarray
    hint: tuple[np.ndarray, np.ndarray]
    tag: np.ndarray
    edge: np.ndarray
    kept: np.ndarray  # which nodes of the trees these are, one tree after the other


def _sums_up(values: np.ndarray, parent: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    total = values.copy()
    for level in levels[:0:-1]:
        np.add.at(total, parent[level], total[level])
    return total


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []


def forest(trees: list[Tree], words: dict[str, int]) -> Forest:
    """The nodes that have text below them, with their features; ``words`` numbers the known hints."""
    sizes = np.array([len(t.tag) for t in trees], np.int64)
    first = np.cumsum(sizes) - sizes
    base = np.repeat(first, sizes)
    parent = np.concatenate([np.array(t.parent, np.int64) for t in trees]) + base
    depth = np.concatenate([np.array(t.depth, np.int64) for t in trees])
    linked = np.concatenate([np.array(t.linked, bool) for t in trees])
    tag = np.array([_TAG.get(name, 0) for t in trees for name in t.tag], np.int64)
    texts = [text for t in trees for text in t.text]
    chars = np.array([len(s) for s in texts], np.int64)
    is_text = tag == _TAG[TEXT]
    levels = _levels(depth)
    total = _sums_up(chars, parent, levels)

    kept = total > 0
    number = np.cumsum(kept) - 1
    stops, gaps = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i in np.flatnonzero(is_text).tolist():
        text = texts[i]
        stops[i] = sum(map(text.count, PUNCTUATION))
        gaps[i] = len(text.split())
    page_chars = np.repeat(total[first], sizes)
    before = np.cumsum(chars) - chars
    place = (before - before[base] + total / 2) / np.maximum(page_chars, 1)
    up = lambda values: _sums_up(values, parent, levels)[kept]
    total, leaves, n_words = total[kept], up(is_text.astype(np.int64)), up(gaps)
    above = np.where(depth > 0, tag[np.maximum(parent, 0)], 0)
    columns = [
        np.minimum(np.log2(total + 1).astype(np.int64), SIZES - 1),
        np.searchsorted(LINKS, up(chars * linked) / total),
        np.searchsorted(STOPS, up(stops) / np.maximum(n_words, 1)),
        np.searchsorted(WORDS, n_words / leaves),
        np.searchsorted(SHARES, total / page_chars[kept]),
        np.searchsorted(PLACES, place[kept]),
        tag[kept],
        above[kept],
    ]
    text_kept = is_text[kept]
    own = np.stack([
        column + offset + width * text_kept
        for column, offset, width in zip(columns, _OFFSETS, _COLUMNS, strict=False)
    ])
    nodes, numbers = [], []
    for t, start in zip(trees, first.tolist()):
        for node, found in t.hints.items():
            if kept[start + node]:
                for word in found:
                    if word in words:
                        nodes.append(number[start + node])
                        numbers.append(words[word])
    tag = tag[kept]
    up_to = number[np.maximum(parent[kept], 0)]
    levels = _levels(depth[kept])
    hinted = np.zeros(len(tag), np.int64)
    hinted[np.array(nodes, np.int64)] = 1
    # A pair weighs by the child's tag, and by whether a name sets the child apart.
    edge = np.stack([tag, len(TAGS) + 1 + 2 * _INLINE[tag] + hinted])
    return Forest(up_to, levels, own, (np.array(nodes, np.int64), np.array(numbers, np.int64)), tag, edge, kept)


@dataclass
class Model:
    """``own``: log-odds of main text by feature; ``hint``: by word; ``pair``: log-potentials of (parent,
    child) labels by the child's edge features."""

    words: dict[str, int]
    own: np.ndarray
    hint: np.ndarray
    pair: np.ndarray


@dataclass
class Beliefs:
    one: np.ndarray  # log-odds of main text
    pair: np.ndarray  # probabilities of (parent, child) labels; nothing for roots
    log_z: float


def odds(model: Model, trees: Forest) -> tuple[np.ndarray, np.ndarray]:
    """Own log-odds of every node, and the potentials of the pair of it and its parent."""
    own = model.own[trees.own].sum(axis=0)
    own += np.bincount(trees.hint[0], model.hint[trees.hint[1]], len(own))
    return own, model.pair[trees.edge].sum(axis=0)


def pass_messages(own: np.ndarray, pair: np.ndarray, parent: np.ndarray, levels: list[np.ndarray]) -> Beliefs:
    """Sum-product on a forest: exact marginals from one pass up and one down.

    ``own[i]`` is the log-odds of label 1 of node i, ``pair[i, a, b]`` the log-potential of label a of its
    parent and b of itself; ``levels`` lists the nodes by depth, the first one being the roots.
    """
    below = np.stack([np.zeros_like(own), own], axis=1)
    sent = np.zeros_like(below)
    for level in levels[:0:-1]:
        sent[level] = np.logaddexp(pair[level, :, 0] + below[level, None, 0], pair[level, :, 1] + below[level, None, 1])
        np.add.at(below, parent[level], sent[level])
    whole = below.copy()
    joint = np.zeros((len(own), 2, 2))
    for level in levels[1:]:
        others = whole[parent[level]] - sent[level]  # all that the parent knows but from this child
        meet = others[:, :, None] + pair[level] + below[level, None, :]
        whole[level] = np.logaddexp(meet[:, 0], meet[:, 1])
        joint[level] = meet - np.logaddexp(whole[level, 0], whole[level, 1])[:, None, None]
    for level in levels[1:]:
        joint[level] = np.exp(joint[level])
    roots = whole[levels[0]] if levels else whole[:0]
    return Beliefs(whole[:, 1] - whole[:, 0], joint, float(np.logaddexp(roots[:, 0], roots[:, 1]).sum()))


def _labels(trees: list[Tree], found: Forest) -> np.ndarray:
    """1 for text in an element marked "yes" (the nearest mark counts) and for elements of which more than
    half of the characters are main text."""
    chars, main = [], []
    for t in trees:
        inside = []
        for node, above in enumerate(t.parent):
            inside.append(t.marks[node] == "yes" if node in t.marks else above >= 0 and inside[above])
        n = np.array([len(s) for s in t.text])
        chars.append(n)
        main.append(n * np.array(inside))
    chars, main = np.concatenate(chars)[found.kept], np.concatenate(main)[found.kept]
    chars, main = (_sums_up(v, found.parent, found.levels) for v in (chars, main))
    return (2 * main > chars).astype(np.int64)


def likelihood(model: Model, trees: Forest, labels: np.ndarray) -> tuple[float, Model]:
    """Log-likelihood of the labels of whole trees, and its gradient in the shape of the model."""
    own, pair = odds(model, trees)
    beliefs = pass_messages(own, pair, trees.parent, trees.levels)
    inner = np.concatenate(trees.levels[1:]) if len(trees.levels) > 1 else np.zeros(0, np.int64)
    above = labels[trees.parent[inner]]
    seen = np.zeros_like(pair)
    seen[inner, above, labels[inner]] = 1
    value = float((own * labels).sum() + pair[inner, above, labels[inner]].sum() - beliefs.log_z)
    miss = labels - _chance(beliefs.one)
    d_own, d_hint, d_pair = (np.zeros_like(x) for x in (model.own, model.hint, model.pair))
    for row in trees.own:
        np.add.at(d_own, row, miss)
    np.add.at(d_hint, trees.hint[1], miss[trees.hint[0]])
    for row in trees.edge:
        np.add.at(d_pair, row[inner], (seen - beliefs.pair)[inner])
    return value, Model(model.words, d_own, d_hint, d_pair)


def _chance(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(log_odds, -700, 700)))


def train(pages: list[str], rounds: int = 200, step: float = 0.15, decay: float = 0.02) -> Model:
    """The model of labelled ``pages``: HTML with main text marked as in ``page_layouts``. Gradient ascent
    with a step of its own for every weight, as in Adam; ``decay`` pulls weights to zero."""
    trees = [parse(page, MARK) for page in pages]
    words = {w: i for i, w in enumerate(sorted({w for t in trees for found in t.hints.values() for w in found}))}
    shapes = ((int(_OFFSETS[-1]),), (len(words),), (len(TAGS) + 5, 2, 2))
    model = Model(words, *[np.zeros(s) for s in shapes])
    if not trees:
        return model
    found = forest(trees, words)
    labels = _labels(trees, found)
    first, second = ([np.zeros(s) for s in shapes] for _ in range(2))
    for t in range(1, rounds + 1):
        _, slope = likelihood(model, found, labels)
        for i, name in enumerate(("own", "hint", "pair")):
            weights = getattr(model, name)
            g = getattr(slope, name) - decay * weights
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            weights += step * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.99**t)) + 1e-8)
    return model


def chances(model: Model, trees: list[Tree]) -> list[np.ndarray]:
    """For every tree the probability of each node to be main text; 0 where there is nothing to read."""
    found = forest(trees, model.words)
    whole = np.zeros(len(found.kept))
    whole[found.kept] = _chance(pass_messages(*odds(model, found), found.parent, found.levels).one)
    return np.split(whole, np.cumsum([len(t.tag) for t in trees])[:-1])


def sentences_of(pages: DataFrame, page: str = "html", most_pages: int = 200, most: int = 4000) -> list[str]:
    """At most ``most`` sentences of at most ``most_pages`` pages, those of the smallest hashes: what the labelled
    pages are filled with."""
    whole = F.col(f"`{page}`").cast("string")
    rows = pages.select(whole.alias("page")).filter("page IS NOT NULL").select("page", F.xxhash64("page").alias("h"))
    sample = rows.orderBy("h", "page").limit(most_pages)
    bare = F.regexp_replace("page", r"(?is)<(script|style|title)\b.*?</\1\s*>|<[^>]*>", "\n")
    parts = sample.select(F.explode(F.split(bare, r"\n|(?<=[.!?])\s+")).alias("s"))
    clean = parts.select(F.trim(F.regexp_replace("s", r"\s+", " ")).alias("s")).filter("length(s) BETWEEN 1 AND 400")
    return [r["s"] for r in clean.select("s", F.xxhash64("s").alias("h")).distinct().orderBy("h", "s").limit(most).collect()]


def learn_extractor(pages: DataFrame, page: str = "html", n_labelled: int = 400, most_pages: int = 200) -> Model:
    """A model trained on ``n_labelled`` pages of known layout (``page_layouts``), filled with sentences of at most
    ``most_pages`` of ``pages``. Both numbers bound what the driver holds; no rows are needed, since the
    layouts have a few sentences of their own. For pages labelled by hand, call ``train``."""
    return train(labelled_pages(sentences_of(pages, page, most_pages), n_labelled))


def extract_main_text(
    pages: DataFrame, model: Model, html: str = "html", threshold: float = 0.5, keep: list[str] | None = None
) -> DataFrame:
    """``pages`` with ``text``, the main text, and ``n_chars``, its code points.

    Text is kept where its chance to be main text is ``threshold`` or more. Character references are
    decoded, white space within a block (and a line break) becomes one space, blocks are joined by one in
    the order of the page. Scripts, styles, titles and comments of the source are never text.

    A null or empty page has the empty text. Every row is handled by itself: repeated rows repeat, an
    empty table stays empty. A task holds the trees of a block of about a megabyte or of its longest page;
    elements nested more than 512 deep count as parts of the one at that depth. Columns with the new
    names are replaced; ``keep`` names the others that stay.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)  # weights of a few hundred words and features

    def compute(column: pa.Array) -> list[pa.Array]:
        texts: list[str] = []
        sizes = np.cumsum(pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False))
        low = 0
        while low < len(column):
            reach = (sizes[low - 1] if low else 0) + BLOCK_CHARS
            high = max(low + 1, int(np.searchsorted(sizes, reach, "right")))
            trees = [parse(page or "") for page in column[low:high].to_pylist()]
            for tree, chance in zip(trees, chances(shared.value, trees)):
                texts.append(joined(tree, (chance >= threshold).tolist()))
            low = high
        made = pa.array(texts, pa.string())
        return [made, pc.utf8_length(made).cast(pa.int64())]

    fields = [StructField("text", StringType()), StructField("n_chars", LongType())]
    return add_columns(pages, html, fields, compute, keep)
