import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from kindred.llm import masked_lm
from kindred.llm.buffers import NOT_SPACE, hashes, spans, utf8
from kindred.llm.masked_lm import REACH, count_words, learn_vocabulary, score_documents, train_masked_lm


def grammar(draw, n):
    """Words that their neighbours tell: every a is between a b and a c, and so on."""
    out = []
    while len(out) < n:
        out += draw.choice([["b", "a", "c"], ["y", "x", "z"], ["q", "p", "r"], ["k", "l", "m"]])
    return " ".join(out[:n])


def make(spark, draw, rows=240):
    return spark.createDataFrame([(i, grammar(draw, 200)) for i in range(rows)], "doc_id int, text string").repartition(4)


def word_hash(word):
    data, offsets = utf8(pa.array([word]))
    return int(hashes(data, *spans(data, offsets, NOT_SPACE))[0])


def cell(word):
    """How a word begins and ends: hashes of its first and last three bytes."""
    raw = word.encode()
    return word_hash(raw[:3].decode("latin1")) % 64 * 64 + word_hash(raw[-3:].decode("latin1")) % 64 if raw.isascii() else None


def token_of(vocabulary, word):
    own = int(vocabulary.own_tokens(np.array([word_hash(word)], np.uint64))[0])
    return own if own >= 0 else len(vocabulary.known) + cell(word) // 64


def test_counts_and_classes(spark):
    docs = spark.createDataFrame([("a A b",), (None,), ("",), ("b b c",), ("b b c",)], "text string")
    counts = count_words(docs, "text")
    got = {r["word"] % (1 << 64): r["n"] for r in counts.collect()}
    assert got == {word_hash("a"): 2, word_hash("b"): 5, word_hash("c"): 2}
    vocabulary = learn_vocabulary(counts, size=2)
    assert len(vocabulary.known) == 2 and vocabulary.pad == 2 + masked_lm.BUCKETS
    assert {r["word"] % (1 << 64): r["cell"] for r in counts.collect()} == {word_hash(w): cell(w) for w in "abc"}
    assert token_of(vocabulary, "b") == 0
    assert sorted(token_of(vocabulary, w) for w in "ac")[0] == 1 and token_of(vocabulary, "d") == 2 + cell("d") // 64
    for g in set(vocabulary.group):
        assert abs(np.exp(vocabulary.log_share[vocabulary.group == g]).sum() - 1) < 1e-5
    assert np.allclose(np.exp(vocabulary.log_end).sum(1), 1, atol=1e-5)


def plain_score(model, counts, text):
    """Sum over the words of the log of P(class) P(token | class) P(end | token) (share of the count), each softmax
    over all its values, written out for one word at a time."""
    net, vocabulary = model.network, model.vocabulary
    words = (text or "").split()
    tokens = [token_of(vocabulary, w) for w in words]
    around = [vocabulary.pad] * REACH + tokens + [vocabulary.pad] * REACH

    def log_softmax(x):
        return x - np.log(np.exp(x - x.max()).sum()) - x.max()

    total = 0.0
    for at, (word, token) in enumerate(zip(words, tokens), REACH):
        left = np.mean([net.embed[around[at - d]] for d in range(2, REACH + 1)], axis=0)
        right = np.mean([net.embed[around[at + d]] for d in range(2, REACH + 1)], axis=0)
        x = np.concatenate([net.embed[around[at - 1]], left, net.embed[around[at + 1]], right]).astype(float)
        hidden = np.tanh(x @ net.into + net.into_bias)
        group = vocabulary.group[token]
        total += log_softmax(hidden @ net.out + net.out_bias)[group]
        members = [t for t in vocabulary.order if vocabulary.group[t] == group]
        rows = {t: net.within[list(vocabulary.order).index(t)] for t in members}
        logits = np.array([hidden @ net.narrow @ rows[t] + vocabulary.log_share[t] for t in members])
        total += log_softmax(logits)[members.index(token)]
        if token >= len(vocabulary.known):
            begin, end = divmod(cell(word), 64)
            total += log_softmax(np.array([hidden @ net.narrow @ net.ends[e] + vocabulary.log_end[begin, e] for e in range(64)]))[end]
            known = set(vocabulary.known.tolist())
            alike = {w: n for w, n in counts.items() if cell(w) == cell(word) and word_hash(w) not in known}
            total += math.log(counts.get(word, 0) + 0.5) - math.log(sum(alike.values()) + 0.5 * (len(alike) + 1))
    return len(words), total


def test_scores_are_those_of_the_plain_version(spark):
    draw = random.Random(16)
    rare = ["reading", "readying", "retiring", "singing", "singeing", "ready", "king"]
    texts = [grammar(draw, 60).split() for _ in range(60)]
    for words in texts:
        for _ in range(6):
            words.insert(draw.randrange(len(words)), draw.choice(rare))
    docs = spark.createDataFrame([(" ".join(words),) for words in texts], "text string").repartition(3)
    counts = Counter(w for words in texts for w in words)
    for size in (4, 8, 100):
        model = train_masked_lm(docs, size=size, masked=1)
        asked = [grammar(draw, 12), "a", "", None, "unseen words only reading", " ".join(texts[0]), "singing king reeling"]
        got = {r["id"]: r for r in score_documents(spark.createDataFrame(list(enumerate(asked)), "id int, text string"), model).collect()}
        for i, text in enumerate(asked):
            n, total = plain_score(model, counts, text)
            assert got[i]["n_words"] == n and math.isclose(got[i]["log_likelihood"], total, rel_tol=1e-4, abs_tol=1e-5)
            assert (got[i]["mean_log_likelihood"] is None) == (n == 0)


def test_neighbours_tell_more_than_counts_and_reruns_agree(spark):
    draw = random.Random(17)
    docs = make(spark, draw)
    model = train_masked_lm(docs)
    text = grammar(draw, 3000)
    shuffled = text.split()
    draw.shuffle(shuffled)
    ask = spark.createDataFrame([(0, text), (1, " ".join(shuffled))], "id int, text string")
    mean = {r["id"]: r["mean_log_likelihood"] for r in score_documents(ask, model).collect()}
    counts = Counter(text.split())
    unigram = sum(n * math.log(n / 3000) for n in counts.values()) / 3000
    assert mean[0] > unigram + 0.5 and mean[0] > mean[1] + 0.5
    again = train_masked_lm(docs)
    for a, b in zip(model.network.parts(), again.network.parts()):
        assert (a == b).all()


def test_an_empty_table_gives_the_untrained_network(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    model = train_masked_lm(docs)
    assert score_documents(docs, model).collect() == []
    row = score_documents(spark.createDataFrame([("a b",)], "text string"), model).first()
    assert row["n_words"] == 2 and math.isfinite(row["log_likelihood"])


def test_a_word_beyond_the_vocabulary_has_its_own_count(spark):
    text = "a a a a a a b b b b b c c c c c d d d d d often1ten often1ten often1ten often1ten often2ten"
    docs = spark.createDataFrame([(text,), (None,)], "text string")
    model = train_masked_lm(docs, size=4)
    ask = spark.createDataFrame([(w, "kept") for w in ("often1ten", "often2ten", "often3ten", "", "a")], "text string, word string")
    got = {r["text"]: r for r in score_documents(ask, model).collect()}
    assert [r.asDict().keys() for r in got.values()][0] == {"text", "word", "n_words", "log_likelihood", "mean_log_likelihood"}
    score = {w: r["log_likelihood"] for w, r in got.items()}
    # Three words begin and end alike; smoothed by a half, the unseen ones counted as one more.
    assert math.isclose(score["often1ten"] - score["often2ten"], math.log(4.5 / 1.5), abs_tol=1e-5)
    assert math.isclose(score["often2ten"] - score["often3ten"], math.log(1.5 / 0.5), abs_tol=1e-5)
    assert got[""]["n_words"] == 0 and score[""] == 0 and got[""]["mean_log_likelihood"] is None


def test_the_network_keeps_its_size_and_the_counts_grow(spark):
    def trained(n):
        docs = spark.createDataFrame([(" ".join(f"w{i}" for i in range(n)),)], "text string")
        return train_masked_lm(docs, size=10)

    small, large = trained(40), trained(400)
    assert [p.shape for p in small.network.parts()] == [p.shape for p in large.network.parts()]
    assert (small.counts.count(), large.counts.count()) == (40, 400)


def test_words_beyond_the_vocabulary_are_told_by_their_neighbours(spark):
    draw = random.Random(19)
    # No word is a token: "pre…ing" always follows "the…", "con…ion" always follows "one…".
    pairs = [("the{}xx", "pre{}ing"), ("one{}yy", "con{}ion")]
    texts = [" ".join(w.format(draw.randrange(60)) for _ in range(60) for w in draw.choice(pairs)) for _ in range(300)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    model = train_masked_lm(docs, size=0, masked=1)
    ask = spark.createDataFrame([("right", "the1xx pre2ing"), ("wrong", "one1yy pre2ing")], "name string, text string")
    alone = {r["text"]: r["log_likelihood"] for r in score_documents(
        spark.createDataFrame([("the1xx",), ("one1yy",)], "text string"), model).collect()}
    got = {r["name"]: r["log_likelihood"] for r in score_documents(ask, model).collect()}
    assert got["right"] - alone["the1xx"] > got["wrong"] - alone["one1yy"] + 1


def test_targets_do_not_depend_on_blocks():
    from kindred.llm.buffers import blocks

    draw = random.Random(20)
    texts = [grammar(draw, 40) for _ in range(30)]
    vocabulary = masked_lm.Vocabulary(*[np.zeros(0, np.uint64), np.zeros(0, np.int64)], np.zeros(64, np.int64), *[np.zeros(0)] * 6)

    def chosen(column, rows):
        out = []
        for _, _, data, offsets in blocks(column, most_rows=rows):
            laid = masked_lm._laid_out(data, offsets, vocabulary)
            picked = np.zeros(len(laid.at), bool)
            picked[masked_lm._targets(laid, 4)] = True
            out += [picked[a:b].tolist() for a, b in zip(laid.first, laid.first[1:])]
        return out

    whole = chosen(pa.array(texts), 30)
    assert chosen(pa.array(texts), 4) == whole and chosen(pa.array(texts[::-1]), 7) == whole[::-1]
    assert 0.15 < np.mean(sum(whole, [])) < 0.35


def test_tokens_within_a_class_are_told_by_their_neighbours(spark, monkeypatch):
    monkeypatch.setattr(masked_lm, "HEAD", 0)
    monkeypatch.setattr(masked_lm, "TAIL", 16)  # few words: as many classes as were cut for them before
    draw = random.Random(18)
    # Equal counts throughout, so that counts tell nothing: the word after a{i} is always b{i}.
    docs = spark.createDataFrame(
        [(" ".join(f"a{k} b{k}" for k in (draw.randrange(40) for _ in range(200))),) for _ in range(400)], "text string"
    ).repartition(4)
    model = train_masked_lm(docs)
    group = model.vocabulary.group
    token = {w: token_of(model.vocabulary, w) for w in (f"b{k}" for k in range(40))}
    pairs = [(a, b) for a in token for b in token if a < b and group[token[a]] == group[token[b]]]
    assert len(pairs) >= 20  # classes hold several words
    ask = spark.createDataFrame([(f"{a} {w}", f"a{a[1:]} {w}") for a, b in pairs for w in (a, b)], "name string, text string")
    score = {r["name"]: r["log_likelihood"] for r in score_documents(ask, model).collect()}
    # The right word beats the other one of its class by more than the counts say.
    gains = [score[f"{a} {a}"] - score[f"{a} {b}"] - float(model.vocabulary.log_share[token[a]] - model.vocabulary.log_share[token[b]]) for a, b in pairs]
    assert np.mean(gains) > 0.5


def test_softmaxes_of_any_size_agree_with_plain_ones():
    rng = np.random.default_rng(5)
    for shift in (0.0, 60.0, 200.0, -60.0, -200.0):
        logits = (rng.normal(0, 3, (7, 11)) + shift).astype(np.float32)
        logits[:, 3] -= shift  # columns of their own size
        whole = logits.astype(float)
        plain = whole - whole.max(0) - np.log(np.exp(whole - whole.max(0)).sum(0))
        assert np.allclose(masked_lm._softmax(logits.copy()), np.exp(plain), atol=1e-5)
        wanted = rng.integers(0, 7, 11)
        assert np.allclose(masked_lm._told(logits, wanted), plain[wanted, np.arange(11)], atol=1e-4)


def test_hyperbolic_tangents_agree_with_plain_ones():
    x = np.array([-200, -50, -3, -1e-3, 0, 1e-3, 0.5, 3, 20, 50, 200], np.float32)
    assert np.allclose(masked_lm._tanh(x.copy()), np.tanh(x.astype(float)), atol=1e-6)
    assert masked_lm._tanh(np.array([masked_lm.SATURATED], np.float32))[0] == 1


def test_tokens_are_found_by_their_hashes_also_where_beginnings_are_shared():
    rng = np.random.default_rng(6)
    known = np.unique(np.concatenate([
        rng.integers(0, 1 << 63, 300).astype(np.uint64) * np.uint64(2), np.arange(5, 12, dtype=np.uint64),
        np.uint64((1 << 64) - 1) - np.arange(4, dtype=np.uint64),
    ]))
    number = rng.permutation(len(known))
    empty = np.zeros(0)
    vocabulary = masked_lm.Vocabulary(known, number, *[empty] * 7)
    words = np.concatenate([known, known ^ np.uint64(1), rng.integers(0, 1 << 63, 500).astype(np.uint64)])
    numbers = dict(zip(known.tolist(), number.tolist(), strict=True))
    assert vocabulary.own_tokens(words).tolist() == [numbers.get(w, -1) for w in words.tolist()]
    none = masked_lm.Vocabulary(known[:0], number[:0], *[empty] * 7)
    assert none.own_tokens(words[:3]).tolist() == [-1, -1, -1]
