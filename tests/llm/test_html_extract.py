import html
import itertools
import re

import numpy as np
import pytest

from kindred.llm import dom, html_extract as he, page_layouts as pl, queries


@pytest.fixture(scope="module")
def model():
    return he.train(pl.labelled_pages([], 400))


def text_of(model, page):
    tree = dom.parse(page)
    return dom.joined(tree, he.chances(model, [tree])[0] >= 0.5)


# --- trees ---

def test_trees_follow_html():
    def paths(page):
        tree = dom.parse(page)
        out = []
        for node, text in enumerate(tree.text):
            if text:
                path, at = [], tree.parent[node]
                while at > 0:
                    path.append(tree.tag[at])
                    at = tree.parent[at]
                out.append(("/".join(reversed(path)), text))
        return out

    assert paths("<p>a<p>b<div>c</div>") == [("p", "a"), ("p", "b"), ("div", "c")]
    assert paths("<ul><li>a<li>b<ul><li>c</ul>d</ul>e") == [("ul/li", "a"), ("ul/li", "b"), ("ul/li/ul/li", "c"), ("ul/li", "d"), ("", "e")]
    assert paths("<table><tr><td>a<td>b<tr><td>c</table>d") == [("table/tr/td", "a"), ("table/tr/td", "b"), ("table/tr/td", "c"), ("", "d")]
    assert paths("<b><p>a</b>b</p>c</b>d") == [("b/p", "a"), ("b/p", "b"), ("b", "c"), ("", "d")]
    assert paths("<h2>a</h3>b") == [("h2", "a"), ("", "b")]
    assert paths('<head><title>no</title><p class="a>b">x') == [("p", "x")]
    assert paths("<script>if (a < b) '</p>'</script>x<style>p</style><!-- <p>y --> z<!-->w") == [("", "x"), ("", " z"), ("", "w")]
    assert paths("<svg><text>no</text></svg><template><p>no</p></template>x") == [("", "x")]
    assert [t for _, t in paths("x<p")] == ["x"] and paths("") == []


def test_text_is_joined_by_blocks():
    said = lambda page: (lambda t: dom.joined(t, [True] * len(t.tag)))(dom.parse(page))
    assert said("<p>a<b>b</b>c</p><p>\n d \t e</p>f<br>g<td>h</td>i") == "abc d e f g h i"
    assert said("<p>a&nbsp;b &amp;amp; &lt;i&gt;") == "a b &amp; <i>"
    assert said("a < b <3 <i>x</i> y") == "a < b <3 x y"


@pytest.mark.parametrize("page", [
    "<i><div>" + "<b>" * 30_000 + "</i>" * 30_000 + "x", "<div>" * 30_000 + "x", "<" * 50_000, "<a href='" * 20_000,
    "<!--" * 20_000, "<ul><li>" * 20_000, '<p a="' * 20_001, "<script>" * 20_000, "&" * 100_000, "</p>" * 50_000, "<table><tr><td>" * 5_000,
])
def test_broken_pages_take_linear_time(model, page):
    import time

    start = time.perf_counter()
    text_of(model, page)
    assert time.perf_counter() - start < 10


# --- messages ---

def test_marginals_are_those_of_all_labellings():
    draw = np.random.default_rng(1)
    for n in (1, 2, 5, 9):
        for roots in (1, 2):
            parent = np.array([max(0, i - 1) if i < roots else int(draw.integers(0, i)) for i in range(n)])
            parent[: min(roots, n)] = 0
            depth = np.zeros(n, int)
            for i in range(roots, n):
                depth[i] = depth[parent[i]] + 1
            own, pair = draw.normal(size=n) * 2, draw.normal(size=(n, 2, 2)) * 2
            got = he.pass_messages(own, pair, parent, he._levels(depth))
            weight, ones, joint = 0.0, np.zeros(n), np.zeros((n, 2, 2))
            for labels in itertools.product((0, 1), repeat=n):
                score = sum(own[i] * labels[i] for i in range(n))
                score += sum(pair[i, labels[parent[i]], labels[i]] for i in range(n) if depth[i])
                w = np.exp(score)
                weight += w
                ones += w * np.array(labels)
                for i in range(n):
                    joint[i, labels[parent[i]], labels[i]] += w
            assert np.allclose(he._chance(got.one), ones / weight)
            inner = depth > 0
            assert np.allclose(got.pair[inner], joint[inner] / weight) and np.isclose(got.log_z, np.log(weight))


def test_the_slope_is_that_of_the_likelihood():
    trees = [dom.parse(p, pl.MARK) for p in pl.labelled_pages([], 4)]
    words = {w: i for i, w in enumerate(sorted({w for t in trees for found in t.hints.values() for w in found}))}
    found = he.forest(trees, words)
    labels = he._labels(trees, found)
    draw = np.random.default_rng(2)
    shapes = (int(he._OFFSETS[-1]),), (len(words),), (len(he.TAGS) + 5, 2, 2)
    model = he.Model(words, *[draw.normal(size=s) * 0.3 for s in shapes])
    _, slope = he.likelihood(model, found, labels)
    for name in ("own", "hint", "pair"):
        weights, d = getattr(model, name), getattr(slope, name)
        for at in draw.choice(weights.size, 8, replace=False):
            place = np.unravel_index(at, weights.shape)
            was, values = weights[place], []
            for step in (1e-5, -1e-5):
                weights[place] = was + step
                values.append(he.likelihood(model, found, labels)[0])
            weights[place] = was
            assert np.isclose((values[0] - values[1]) / 2e-5, d[place], atol=1e-3)


def test_depths_beyond_the_deepest_keep_their_text(model):
    tree = dom.parse("<article>" + "<div>" * 2000 + "word " * 50 + "</div>" * 2000 + "<p>after</article>")
    assert max(tree.depth) <= dom.DEEPEST and dom.joined(tree, [True] * len(tree.tag)).endswith("after")


# --- pages ---

def test_held_out_layouts(model):
    pages = pl.labelled_pages([], 200, seed=77)
    right = whole = 0
    for page in pages:
        tree = dom.parse(page, pl.MARK)
        found = he.forest([tree], model.words)
        labels = np.zeros(len(tree.tag), int)
        labels[found.kept] = he._labels([tree], found)
        size = np.array([len(t) for t in tree.text])
        right += (size * ((he.chances(model, [tree])[0] >= 0.5) == labels)).sum()
        whole += size.sum()
    assert right > 0.97 * whole


PROSE = "The river rose in the night, and by noon the bridge was closed. Nobody had expected that, least of all the mayor. "


@pytest.mark.parametrize("noise", [
    '<div id="cookie-bar" class="consent"><p>We use cookies. By staying here you agree to that, and to more.</p><button>OK</button></div>',
    '<section class="comments"><h3>3 comments</h3><div class="comment"><b>Ann</b><p>I was there, and it was not like that at all.</p></div></section>',
    '<aside class="sidebar"><h4>Related</h4><ul><li><a href="/a">One more flood</a><li><a href="/b">The old mill</a></ul></aside>',
    '<form action="/s"><label>Your mail</label><input name="m"><button>Sign up</button></form>',
    '<div class="ad">Buy our boots, they are dry and warm.</div>', '<footer><p>&copy; The Paper. All rights reserved.</p></footer>',
    '<nav><a href="/">Home</a> <a href="/n">News</a> <a href="/s">Sport</a></nav>', '<script>var a = "<p>no</p>";</script>',
    '<header class="masthead"><a href="/">The Paper</a><p>News since 1901</p></header>', '<div role="alert">Your session has ended. Please log in again.</div>',
])
@pytest.mark.parametrize("shell", ["<article><h1>{t}</h1>{p}</article>", '<div class="post-content"><h2>{t}</h2>{p}</div>', "<main>{p}</main>"])
def test_noise_beside_an_article(model, noise, shell):
    body = "".join(f"<p>{PROSE * n}</p>" for n in (1, 3, 2))
    article = shell.format(t="High water in the valley", p=body)
    want = " ".join(re.sub("<[^>]*>", " ", article).split())
    for page in (noise + article, article + noise):
        assert text_of(model, f"<!DOCTYPE html><html><head><title>x</title></head><body>{page}</body></html>") == want


def test_the_whole_table_gives_its_articles(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["page_id"]: r for r in queries.op13_html_extraction(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    right = 0
    for row in pages:
        article = re.search("(?s)<article>(.*)</article>", row["html"])[1]
        bare = re.sub("</?b>", "", article)
        want = " ".join(html.unescape(re.sub("</?[a-z][^>]*>", " ", bare)).split())
        mine = got[row["page_id"]]
        assert mine["n_chars"] == len(mine["text"]) and mine["url"] == row["url"]
        right += mine["text"] == want
    assert right >= 0.98 * len(pages)


def test_nothing_to_extract(spark, model):
    rows = [(1, None), (2, ""), (3, "<p>"), (4, "<html><head><title>x</title></head></html>"), (5, "<script>a"), (5, "<script>a")]
    docs = spark.createDataFrame(rows, "page_id long, html string")
    assert [tuple(r)[-2:] for r in he.extract_main_text(docs, model).collect()] == [("", 0)] * len(rows)
    assert he.extract_main_text(docs.limit(0), model).collect() == []
    assert he.sentences_of(docs.limit(0)) == []
