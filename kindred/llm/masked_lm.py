"""Masked pseudo-likelihood: a small network predicts every word from the words on both sides.

The words of the whole corpus are counted. The most frequent are tokens of their own, a fixed number; the
others are told by two parts of them, their first and their last letters, each hashed to one of 64 values: a
word shares a token with those that begin alike, and how it ends is predicted next. The network so has the
same size for every corpus; the counts grow with it and stay distributed.

The most frequent tokens are classes by themselves, the others are put into classes of about equal weight by
frequency. The network reads the ``REACH`` tokens on either side of a masked one, the nearest ones each by
itself and the others as a mean. What it reads gives the probabilities of the classes, and from the same hidden
values those of the tokens within a class and of the endings of a shared token (softmaxes that start from the
counts). Among the words that begin and end alike, a word has its own share of the counts, for which texts are
joined with the distributed table; all unseen ones together have the share of one more word that was
never met. The logarithms of these conditional probabilities, summed over a text, are its score.

Training runs where the data is: every task takes a copy of the network through its documents, and
the copies are averaged. A round trains on one part of the documents, so each is read once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField

from kindred.llm.buffers import NOT_SPACE, add_columns, blocks, fresh_name, hashes, mix, per_row, spans
from kindred.session import checkpoint

REACH = 3
WIDTH, HIDDEN = 16, 32
HEAD, TAIL = 64, 32  # classes: of single tokens, and of several
TOKENS = 8192  # words that are tokens of their own
BUCKETS = 64  # values of how a word begins, and of how it ends
LETTERS = 3  # bytes that count as its beginning, and as its end
SMOOTH = 0.5  # added to the count of every word in a bucket, and the count of the unseen ones
BATCH = 2048  # examples per step
MASKED = 4  # one word in so many is a target in training
RATE = 0.15
FIXED = 1 << 24  # weights are added up as integers, so that the order of adding does not matter
LEAST_SUM, MOST_SUM = 1e-20, 1e30  # of powers that need nothing taken off
LOOKED_AT = 18  # bits that a hash is looked up by
SATURATED = 20.0  # its hyperbolic tangent is 1
_SCORED = 2048, 16_384  # words whose classes are predicted together, and whose places in their classes are


@dataclass(frozen=True)
class Vocabulary:
    known: np.ndarray  # hashes of the tokens, sorted
    number: np.ndarray  # their token numbers
    group: np.ndarray  # token to class
    log_share: np.ndarray  # log of a token's share of its class
    order: np.ndarray  # tokens class by class
    cuts: np.ndarray  # where each class begins in ``order``, and the end
    log_class: np.ndarray  # log of a class's share of all words
    log_weight: np.ndarray  # (beginning, end): log of the smoothed counts of such words, added up
    log_end: np.ndarray  # (beginning, end): log of the share of an end among words with a beginning, float32

    @property
    def pad(self) -> int:
        return len(self.group)

    @cached_property
    def place(self) -> np.ndarray:
        """Where each token is in ``order``."""
        return np.argsort(self.order)

    @cached_property
    def share_in_order(self) -> np.ndarray:
        return self.log_share[self.order]

    def own_tokens(self, words: np.ndarray) -> np.ndarray:
        """Of words by their hashes: the tokens of those that are tokens, -1 for the others."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.known):
            return out
        first, most = self.looked_up
        place = first[words >> np.uint64(64 - LOOKED_AT)]
        for step in range(most):
            at = np.minimum(place + step, len(self.known) - 1)
            hit = np.flatnonzero(self.known[at] == words)
            out[hit] = self.number[at[hit]]
        return out

    @cached_property
    def looked_up(self) -> tuple[np.ndarray, int]:
        """The place in ``known`` of the first hash with each beginning, and how many share one at most."""
        edges = np.searchsorted(self.known >> np.uint64(64 - LOOKED_AT), np.arange((1 << LOOKED_AT) + 1, dtype=np.uint64))
        return edges[:-1].astype(np.int32), int(np.diff(edges).max())

    def shared_tokens(self, cells: np.ndarray) -> np.ndarray:
        """Of the other words, by their cells (``cells_of``)."""
        return len(self.known) + cells // BUCKETS


@dataclass
class Network:
    embed: np.ndarray
    into: np.ndarray
    into_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    narrow: np.ndarray  # hidden values to what the tokens within a class, and the ends, are told by
    ends: np.ndarray  # a row per end
    within: np.ndarray  # a row per token, class by class

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.into, self.into_bias, self.out, self.out_bias, self.narrow, self.ends, self.within]

    # For scoring, a column of ones goes along with the hidden values, so that the products add what is constant.

    @cached_property
    def read(self) -> list[np.ndarray]:
        """What each token adds to the hidden values: next to the masked one, which brings the bias, and farther off,
        left and right. The last column ends as a one."""
        parts = self.embed @ self.into.reshape(4, WIDTH, HIDDEN)
        tables = [np.zeros((len(self.embed), HIDDEN + 1), np.float32) for _ in parts]
        for k, part in enumerate(parts):
            tables[k][:, :-1] = part / (REACH - 1) if k % 2 else part
        tables[0] += np.append(self.into_bias, np.float32(SATURATED))
        return tables

    @cached_property
    def classes_told(self) -> np.ndarray:
        return np.vstack([self.out, self.out_bias]).T.copy()

    @cached_property
    def narrowed(self) -> np.ndarray:
        whole = np.zeros((HIDDEN + 1, WIDTH + 1), np.float32)
        whole[:-1, :-1], whole[-1, -1] = self.narrow, 1
        return whole

    def told_within(self, vocabulary: Vocabulary) -> np.ndarray:
        return np.column_stack([self.within, vocabulary.share_in_order])


def new_network(vocabulary: Vocabulary, seed: int) -> Network:
    """Its tokens within a class have their shares of the counts, until it is trained."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (vocabulary.pad + 1, WIDTH))
    embed[-1] = 0  # beyond the ends of a text
    return Network(*(x.astype(np.float32) for x in (
        embed, rng.normal(0, 0.1, (4 * WIDTH, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, (HIDDEN, len(vocabulary.log_class))),
        vocabulary.log_class, rng.normal(0, 0.3, (HIDDEN, WIDTH)), np.zeros((BUCKETS, WIDTH)),
        np.zeros((vocabulary.pad, WIDTH)),
    )))


def cells_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How words begin and end, as beginning * ``BUCKETS`` + end: hashes of their first and last bytes."""
    part = lambda a, b: (hashes(data, a, b) % np.uint64(BUCKETS)).astype(np.int64)
    return part(starts, np.minimum(starts + LETTERS, ends)) * BUCKETS + part(np.maximum(ends - LETTERS, starts), ends)


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(``word``, ``cell``, ``n``): the hash, the cell and the number of every word of the corpus, added up within
    tasks first."""
    def counts(batches):
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                starts, ends = spans(data, offsets, NOT_SPACE)
                found, first, n = np.unique(hashes(data, starts, ends), return_index=True, return_counts=True)
                order = np.argsort(first)  # spans are hashed in the order of the bytes
                cells = np.empty(len(first), np.int64)
                cells[order] = cells_of(data, starts[first[order]], ends[first[order]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(cells), pa.array(n)], names=["word", "cell", "n"]
                )

    texts = docs.select(docs[f"`{text}`"].cast("string").alias("text"))
    found = texts.mapInArrow(counts, "word long, cell long, n long")
    return found.groupBy("word").agg(F.min("cell").alias("cell"), F.sum("n").alias("n"))


def learn_vocabulary(counts: DataFrame, size: int = TOKENS) -> Vocabulary:
    """From (``word``, ``cell``, ``n``); words of equal count go by their hash. ``size`` words are tokens of their
    own, whatever the number of words: that bounds what reaches the driver and the tasks. Classes beyond the
    ``HEAD`` most frequent tokens are cut by the running sum of the square roots of the counts."""
    totals, distinct = np.zeros(BUCKETS**2), np.zeros(BUCKETS**2)
    for r in counts.groupBy("cell").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
        totals[r["cell"]], distinct[r["cell"]] = r["n"], r["words"]
    # Only words about as frequent as the last one wanted are ranked: no task sends more than its few of them.
    step = F.floor(F.log2("n") * 16).cast("long")
    least, above = 0, 0
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):  # 16 per doubling
        above += r["count"]
        if above >= size:
            least = r["step"]
            break
    rows = counts.filter(step >= least).orderBy(F.desc("n"), "word").limit(size).collect()
    known = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    own = np.array([r["n"] for r in rows], float)
    home = np.array([r["cell"] for r in rows], np.int64)
    np.subtract.at(totals, home, own)
    np.subtract.at(distinct, home, 1)
    totals = np.maximum(totals, 0).reshape(BUCKETS, BUCKETS)
    weight = totals + SMOOTH * (distinct.reshape(BUCKETS, BUCKETS) + 1)
    log_end = np.log(weight) - np.log(weight.sum(1, keepdims=True))
    n = np.concatenate([own, totals.sum(1)]) + 0.5
    order = np.argsort(-n, kind="stable")
    roots = np.sqrt(n[order[HEAD:]])
    group = np.empty(len(n), np.int64)
    group[order[:HEAD]] = np.arange(min(HEAD, len(n)))
    group[order[HEAD:]] = HEAD + np.minimum((np.cumsum(roots) / max(roots.sum(), 1) * TAIL).astype(np.int64), TAIL - 1)
    weights = np.bincount(group, n, HEAD + TAIL)
    log_share = np.log(n) - np.log(weights[group])
    log_class = np.log(np.maximum(weights / weights.sum(), 1e-13))  # a class without tokens gets next to nothing
    cuts = np.append(0, np.cumsum(np.bincount(group, minlength=HEAD + TAIL)))
    by_hash = np.argsort(known)
    return Vocabulary(
        known[by_hash], by_hash, group, log_share.astype(np.float32), order, cuts, log_class, np.log(weight),
        log_end.astype(np.float32),
    )


def _contexts(embed: np.ndarray, tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What stands around the places: both neighbours, and the means of those farther off."""
    near = lambda d: np.take(embed, tokens[at + d], axis=0, mode="clip")
    far = [near(d) for d in range(2, REACH + 1)], [near(-d) for d in range(2, REACH + 1)]
    return np.concatenate([near(-1), sum(far[1]) / len(far[1]), near(1), sum(far[0]) / len(far[0])], axis=1)


def _tanh(x: np.ndarray) -> np.ndarray:
    """Hyperbolic tangents, in place: 1 - 2 / (exp(2x) + 1)."""
    x *= 2
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    np.divide(-2, x, out=x)
    x += 1
    return x


def _exp(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """(powers, their sums, what was taken off each column first). Here a column is an example: so sums run along
    whole rows. Maxima are taken off only where the powers of some column are too large or too small without."""
    with np.errstate(over="ignore"):
        powers = np.exp(logits)
        sums = powers.sum(0)
    if len(sums) and LEAST_SUM < sums.min() and sums.max() < MOST_SUM:
        return powers, sums, None
    most = logits.max(0)
    powers = np.exp(logits - most)
    return powers, powers.sum(0), most


def _softmax(logits: np.ndarray) -> np.ndarray:
    powers, sums, _ = _exp(logits)
    powers /= sums
    return powers


def _class_order(vocabulary: Vocabulary, own: np.ndarray) -> np.ndarray:
    """The order that brings examples, with the tokens ``own``, together by class."""
    return np.argsort(vocabulary.group[own].astype(np.uint8), kind="stable")  # there are fewer than 256 classes


def _by_class(vocabulary: Vocabulary, own: np.ndarray):
    """(first and last place in ``order`` of a class, the examples whose token is in it, the tokens' places
    in the class) for each class of several tokens that is among the tokens ``own``, which lie class by class."""
    group, place = vocabulary.group[own], vocabulary.place[own]
    starts = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
    for first, last in zip(starts, [*starts[1:], len(own)], strict=True):
        low, high = vocabulary.cuts[group[first] : group[first] + 2].tolist()
        if high - low > 1:
            yield low, high, slice(first, last), place[first:last] - low


def _told(logits: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Log-probabilities of the wanted row of each column."""
    _, sums, most = _exp(logits)
    out = logits[wanted, np.arange(len(wanted))] - np.log(sums)
    return out if most is None else out - most


def _log_p(net: Network, vocabulary: Vocabulary, tokens: np.ndarray, ends: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Log-probabilities of the tokens at the places, and of the ends of those that are shared, given the tokens
    on both sides. ``ends`` are the ends of the words at the places."""
    order = _class_order(vocabulary, tokens[places])
    places, ends = places[order], ends[order]
    own, read = tokens[places], net.read
    out = np.empty(len(places), np.float32)
    narrow = np.empty((len(places), WIDTH + 1), np.float32)
    for low in range(0, len(places), _SCORED[0]):
        at = places[low : low + _SCORED[0]]
        hidden = np.take(read[0], tokens[at - 1], axis=0, mode="clip")
        hidden += np.take(read[2], tokens[at + 1], axis=0, mode="clip")
        for d in range(2, REACH + 1):
            hidden += np.take(read[1], tokens[at - d], axis=0, mode="clip")
            hidden += np.take(read[3], tokens[at + d], axis=0, mode="clip")
        _tanh(hidden)
        out[low : low + len(at)] = _told(net.classes_told @ hidden.T, vocabulary.group[own[low : low + len(at)]])
        np.matmul(hidden, net.narrowed, out=narrow[low : low + len(at)])
    within = net.told_within(vocabulary)
    for low, high, rows, inside in _by_class(vocabulary, own):
        out[rows] += _told(within[low:high] @ narrow[rows].T, inside)
    narrow = narrow[:, :-1]
    rows, ends_told = np.flatnonzero(own >= len(vocabulary.known)), vocabulary.log_end.T
    for low in range(0, len(rows), _SCORED[0]):
        some = rows[low : low + _SCORED[0]]
        logits = net.ends @ narrow[some].T
        logits += ends_told[:, own[some] - len(vocabulary.known)]
        out[some] += _told(logits, ends[some])
    told = np.empty_like(out)
    told[order] = out
    return told


@dataclass(frozen=True)
class _Laid:
    """A block's tokens with ``REACH`` pads around every text; of its words the places and hashes, and the cells of
    those that are no tokens of their own (0 for others); the first word of each text, and their number."""

    tokens: np.ndarray
    at: np.ndarray
    words: np.ndarray
    cells: np.ndarray
    first: np.ndarray


def _laid_out(data, offsets, vocabulary: Vocabulary) -> _Laid:
    starts, ends = spans(data, offsets, NOT_SPACE)
    first = per_row(starts, offsets)
    texts = len(offsets) - 1
    at = np.arange(len(starts)) + REACH * (np.repeat(np.arange(texts), np.diff(first)) + 1)
    tokens = np.full(len(starts) + REACH * (texts + 1), vocabulary.pad, np.int64)
    words = hashes(data, starts, ends)
    own, cells = vocabulary.own_tokens(words), np.zeros(len(starts), np.int64)
    other = np.flatnonzero(own < 0)
    cells[other] = cells_of(data, starts[other], ends[other])
    own[other] = vocabulary.shared_tokens(cells[other])
    tokens[at] = own
    return _Laid(tokens, at, words, cells, first)


def _targets(laid: _Laid, masked: int) -> np.ndarray:
    """One word in ``masked``, by the word and its number in its text: the same however texts come in blocks."""
    number = np.arange(len(laid.at)) - np.repeat(laid.first[:-1], np.diff(laid.first))
    return np.flatnonzero(mix(laid.words + number.astype(np.uint64)) % np.uint64(masked) == 0)


class Trainer:
    """Stochastic gradient descent with a step size per weight, over one task's documents."""

    def __init__(self, net: Network, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.net = Network(*(p.copy() for p in net.parts()))
        self.weights = self.net.parts()
        self.squares = [np.full(p.shape, 1e-4, np.float32) for p in net.parts()]
        self.touched = np.zeros(len(net.embed), bool)
        self.told = np.zeros(len(net.within), bool)

    def learn(self, tokens: np.ndarray, ends: np.ndarray, at: np.ndarray) -> None:
        """``at`` are the places to predict, ``ends`` the ends of the words there."""
        net, vocabulary = self.net, self.vocabulary
        for low in range(0, len(at), BATCH):
            places = at[low : low + BATCH]
            order = _class_order(vocabulary, tokens[places])
            places, its_ends = places[order], ends[low : low + BATCH][order]
            own, share = tokens[places], np.float32(1 / len(places))
            x = _contexts(net.embed, tokens, places)
            hidden = x @ net.into
            hidden += net.into_bias
            _tanh(hidden)
            error = _softmax(net.out.T @ hidden.T + net.out_bias[:, None])
            error[vocabulary.group[own], np.arange(len(places))] -= 1
            narrow = hidden @ net.narrow
            shares = narrow * share  # gradients are means: scaled where the arrays are small
            into_narrow = np.zeros_like(narrow)
            for first, last, rows, inside in _by_class(vocabulary, own):
                its = narrow[rows]
                wrong = _softmax(net.within[first:last] @ its.T + vocabulary.share_in_order[first:last, None])
                wrong[inside, np.arange(len(inside))] -= 1
                into_narrow[rows] = wrong.T @ net.within[first:last]
                self._step(7, wrong @ shares[rows], slice(first, last))
                self.told[first:last] = True
            shared = np.flatnonzero(own >= len(vocabulary.known))
            if len(shared):
                its = narrow[shared]
                wrong = _softmax(net.ends @ its.T + vocabulary.log_end.T[:, own[shared] - len(vocabulary.known)])
                wrong[its_ends[shared], np.arange(len(shared))] -= 1
                into_narrow[shared] += wrong.T @ net.ends
                self._step(6, wrong @ shares[shared])
            into_narrow *= share
            back = error.T @ net.out.T
            back *= share
            back += into_narrow @ net.narrow.T
            self._step(5, hidden.T @ into_narrow)
            self._step(3, (error @ hidden).T * share)
            self._step(4, error.sum(1) * share)
            hidden *= hidden
            back *= np.subtract(1, hidden, out=hidden)
            into_x = back @ net.into.T
            self._step(1, x.T @ back)
            self._step(2, back.sum(0))
            self._step_embed(tokens, places, into_x)

    def _step_embed(self, tokens: np.ndarray, places: np.ndarray, into_x: np.ndarray) -> None:
        index, parts = [], []
        for side, sign in ((0, -1), (2, 1)):
            near, far = (into_x[:, (side + k) * WIDTH : (side + k + 1) * WIDTH] for k in (0, 1))
            index.append(tokens[places + sign])
            parts.append(near)
            for d in range(2, REACH + 1):
                index.append(tokens[places + sign * d])
                parts.append(far / (REACH - 1))
        met = np.concatenate(index)
        # Small numbers are sorted by their digits.
        order = np.argsort(met.astype(np.uint16) if len(self.net.embed) <= 1 << 16 else met, kind="stable")
        met = met[order]
        starts = np.flatnonzero(np.diff(met, prepend=-1))
        rows = met[starts]
        sums = np.add.reduceat(np.take(np.concatenate(parts), order, axis=0, mode="clip"), starts, axis=0)
        sums[rows == len(self.net.embed) - 1] = 0  # the pad stays
        squares = np.take(self.squares[0], rows, axis=0, mode="clip")
        squares += sums * sums
        self.squares[0][rows] = squares
        sums /= np.sqrt(squares, out=squares)
        sums *= RATE
        self.net.embed[rows] = np.take(self.net.embed, rows, axis=0, mode="clip") - sums
        self.touched[rows] = True

    def _step(self, k: int, gradient: np.ndarray, rows: slice = slice(None)) -> None:
        squares, weights = self.squares[k][rows], self.weights[k][rows]  # both are views
        squares += gradient * gradient
        gradient /= np.sqrt(squares)
        gradient *= RATE
        weights -= gradient

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """(slot, weights as integers): the weights as rows of ``WIDTH``, of the tokens and classes met and the rest."""
        flat = np.concatenate([p.ravel() for p in self.net.parts()]).reshape(-1, WIDTH)
        last = len(flat) - len(self.told)
        slots = np.concatenate([np.flatnonzero(self.touched), np.arange(len(self.touched), last), last + np.flatnonzero(self.told)])
        return slots, np.round(flat[slots].astype(np.float64) * FIXED).astype(np.int64)


def _rebuilt(like: Network, flat: np.ndarray) -> Network:
    parts, low = [], 0
    for p in like.parts():
        parts.append(flat[low : low + p.size].reshape(p.shape).astype(np.float32))
        low += p.size
    return Network(*parts)


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    network: Network
    counts: DataFrame  # of all words, checkpointed


def train_masked_lm(
    docs: DataFrame, text: str = "text", rounds: int = 2, seed: int = 3, size: int = TOKENS, masked: int = MASKED
) -> Model:
    """Counts the words of all rows, then trains over ``rounds`` parts of them, one after the other.

    Rows are dealt to the parts by a hash of their text. One word in ``masked`` of every text is a target of
    training, chosen by the word and its place, so that copies of a text have the same ones; with 1 every word
    is, which takes so many times as long (the README has the difference in likelihood). All words are read as
    neighbours and all are scored. In a round every task starts from the same weights; a weight's new value is
    its mean over the tasks that used it. What reaches the driver and goes out to the tasks is the network,
    whose size ``size``, the number of tokens, fixes. Null texts have no words; an empty table gives the
    untrained network.
    """
    counts = checkpoint(count_words(docs, text))
    vocabulary = learn_vocabulary(counts, size)
    network = new_network(vocabulary, seed)
    source = docs.select(docs[f"`{text}`"].cast("string").alias("text"))
    fields = ", ".join(["slot long", "tasks long", *[f"w{i} long" for i in range(WIDTH)]])
    for number in range(rounds):
        mine = source.filter(F.pmod(F.xxhash64(F.lit("round"), "text"), F.lit(rounds)) == number)
        shared = docs.sparkSession.sparkContext.broadcast((network, vocabulary))  # a few megabytes, by ``size``

        def train(batches, shared=shared):
            trainer = Trainer(*shared.value)
            for batch in batches:
                for _, _, data, offsets in blocks(batch.column(0)):
                    laid = _laid_out(data, offsets, trainer.vocabulary)
                    chosen = _targets(laid, masked)
                    trainer.learn(laid.tokens, laid.cells[chosen] % BUCKETS, laid.at[chosen])
            if not trainer.touched.any():
                return
            slots, weights = trainer.rows()
            names = ["slot", "tasks", *[f"w{i}" for i in range(WIDTH)]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots), pa.array(np.ones(len(slots), np.int64)), *[pa.array(weights[:, i]) for i in range(WIDTH)]], names=names
            )

        sums = mine.mapInArrow(train, fields).groupBy("slot").agg(
            F.sum("tasks").alias("tasks"), *[F.sum(f"w{i}").alias(f"w{i}") for i in range(WIDTH)]
        )
        flat = np.concatenate([p.ravel() for p in network.parts()]).reshape(-1, WIDTH).astype(np.float64)
        found = sums.toArrow()
        weights = np.column_stack([found[f"w{i}"].to_numpy() for i in range(WIDTH)])
        flat[found["slot"].to_numpy()] = weights / found["tasks"].to_numpy()[:, None] / FIXED
        network = _rebuilt(network, flat.ravel())
    return Model(vocabulary, network, counts)


def score_documents(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``log_likelihood`` (the sum over the words of the logarithm of each
    word's probability given its neighbours) and ``mean_log_likelihood`` (per word).

    A null or empty text has no words, the sum 0 and no mean. Rows are scored one by one: repeated
    rows get the same score, an empty table stays empty, columns with the new names are replaced.
    The kept columns are checkpointed with the words that are not tokens; these words are joined with
    the counts, and their sums with the rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.network, model.vocabulary))

    def compute(column):
        net, vocabulary = shared.value
        words, total = np.zeros(len(column), np.int64), np.zeros(len(column))
        rare, ends = [np.zeros(0, np.int64)], np.zeros(len(column) + 1, np.int64)
        for low, high, data, offsets in blocks(column):
            laid = _laid_out(data, offsets, vocabulary)
            sums = np.zeros(len(laid.at) + 1)
            for a in range(0, len(laid.at), _SCORED[1]):
                some = slice(a, a + _SCORED[1])
                sums[1:][some] = _log_p(net, vocabulary, laid.tokens, laid.cells[some] % BUCKETS, laid.at[some])
            outside = laid.tokens[laid.at] >= len(vocabulary.known)
            sums[1:][outside] -= vocabulary.log_weight.ravel()[laid.cells[outside]]
            sums, first = np.cumsum(sums), laid.first
            words[low:high] = np.diff(first)
            total[low:high] = sums[first[1:]] - sums[first[:-1]]
            rare.append(laid.words[outside].view(np.int64))
            ends[low + 1 : high + 1] = ends[low] + np.append(0, np.cumsum(outside))[first[1:]]
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(rare)))
        return [pa.array(words), pa.array(total), pa.nulls(len(column), pa.float64()), lists]

    new = [
        StructField("n_words", LongType()), StructField("log_likelihood", DoubleType()), StructField("mean_log_likelihood", DoubleType()),
    ]
    kept = docs.columns if keep is None else keep
    rare, row, extra, word = (fresh_name(kept, c) for c in ("rare_words", "row_number", "rare_sum", "rare_word"))
    known = add_columns(docs, text, [*new, StructField(rare, ArrayType(LongType()))], compute, keep)
    known = checkpoint(known.withColumn(row, F.monotonically_increasing_id()))
    # Added up as integers, so that the order of adding does not matter.
    log_n = F.round(F.log(F.coalesce(F.col("n"), F.lit(0)) + F.lit(SMOOTH)) * F.lit(FIXED)).cast("long")
    met = known.select(row, F.explode(F.col(rare)).alias(word)).join(model.counts, F.col(word) == F.col("word"), "left")
    sums = met.groupBy(F.col(row).alias("of_row")).agg((F.sum(log_n) / F.lit(FIXED)).alias(extra))
    whole = known.join(sums, F.col(row) == F.col("of_row"), "left")
    total = F.col("log_likelihood") + F.coalesce(F.col(extra), F.lit(0.0))
    made = {"log_likelihood": total, "mean_log_likelihood": F.when(F.col("n_words") > 0, total / F.col("n_words"))}
    return whole.select(*[
        made[c].alias(c) if c in made else known["`" + c.replace("`", "``") + "`"] for c in known.columns if c not in (rare, row)
    ])
