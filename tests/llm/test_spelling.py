import random
import re
import zlib
from collections import Counter

import pytest

from kindred.llm.spelling import group_variants, near_pairs, word_counts


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain_counts(rows, every=31):
    met = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                met[run] += 1
    return {w: n for w, n in met.items() if n >= 2}


def plain_groups(counts):
    out = {}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


def groups(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_pairs_are_those_of_all_comparisons(spark):
    draw = random.Random(1)
    words = sorted({"".join(draw.choice("abcé") for _ in range(draw.randint(1, 11))) for _ in range(1200)})
    want = {(a, b) for a in words for b in words if one_edit(a, b) and (len(a), a) < (len(b), b)}
    got = [tuple(r) for r in near_pairs(spark.createDataFrame([(w,) for w in words], "word string")).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_every_place_and_kind_of_edit_is_found(spark):
    for word in ("abcdefg", "abcdefghijklmnop", "aaaaaaaaa", "ÿçéàöüßx"):
        edits = {word[:i] + word[i + 1 :] for i in range(len(word))}
        edits |= {word[:i] + "q" + word[i:] for i in range(len(word) + 1)} | {word[:i] + "q" + word[i + 1 :] for i in range(len(word))}
        pairs = near_pairs(spark.createDataFrame([(w,) for w in {word, *edits}], "word string"))
        found = {r["a"] if r["b"] == word else r["b"] for r in pairs.collect() if word in (r["a"], r["b"])}
        assert found == edits


def test_groups_are_those_of_the_plain_version(spark):
    draw = random.Random(2)
    syllables = ["tion", "ment", "the", "an", "ré", "ou", "ing"]
    vocabulary = ["".join(draw.choice(syllables) for _ in range(draw.randint(2, 4))) for _ in range(60)]
    rows = [(i % 90, " ".join(draw.choices(vocabulary, [2**-(k / 6) for k in range(60)], k=draw.randint(0, 200)))) for i in range(120)]
    rows += [(None, "Reading READING reading1reading×reading"), (7, None), (8, ""), (9, "a" * 100_000), (9, "a" * 100_000), (10, "9 _ 日")]
    counts = plain_counts(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS word", "3 AS run", "4 AS id")
    words = word_counts(docs, misspell_every=31)
    assert {r["word"]: r["n"] for r in words.collect()} == counts
    want = plain_groups(counts)
    assert groups(group_variants(words)) == want
    assert any(form for form, *_ in want.values())


def test_chains_are_followed_to_their_end(spark):
    chain = [("aaaaaaa" + "b" * i, 2 * 10**i) for i in range(12)]
    got = groups(group_variants(spark.createDataFrame(chain, "word string, n long")))
    assert {root for _, root, *_ in got.values()} == {chain[-1][0]}
    assert [got[w][0] for w, _ in chain[:-1]] == [w for w, _ in chain[1:]]


def test_ties_go_to_the_smallest_word(spark):
    words = spark.createDataFrame([("abcdefg", 2), ("abcdefx", 50), ("abcdefh", 50), ("lonely", 3)], "word string, n long")
    assert groups(group_variants(words)) == {
        "abcdefg": ("abcdefh", "abcdefh", 2, 2, 50), "abcdefx": (None, "abcdefx", 50, 2, None),
        "abcdefh": (None, "abcdefh", 50, 2, None), "lonely": (None, "lonely", 3, 0, None),
    }
    assert group_variants(words.limit(0)).collect() == []
    with pytest.raises(ValueError):
        group_variants(words, ratio=2)


def test_without_misspelling(spark):
    docs = spark.createDataFrame([(1, "letters Letters LETTERS short")], "doc_id long, text string")
    assert [tuple(r) for r in word_counts(docs).collect()] == [("letters", 3)]


@pytest.mark.parametrize("every", [None, 31])
def test_awkward_tables(spark, every):
    rows = [
        (1, None), (2, ""), (2, " \n\t"), (3, "Vocabulary vocabulery ÉCOLÉS×÷ " * 20_000), (4, "vocabulary words"), (4, "vocabulary words"),
        (None, "vocabulary Vocabularys"), (None, "vocabularys"), (5, "x" * 50_000 + " " + "x" * 50_000 + "y"), (6, "x" * 50_000),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'x' AS word", "7 AS n", "'y' AS l", "'z' AS Run", "map('a', 1) AS `a map`"
    )
    counts = plain_counts(rows, every or 1 << 40)
    assert groups(group_variants(word_counts(docs, misspell_every=every))) == plain_groups(counts)
    assert group_variants(word_counts(docs.limit(0), misspell_every=every)).collect() == []
