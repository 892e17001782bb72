"""Language-model scores of whole texts by a gated recurrent network.

The network (NumPy, one gated recurrent layer) reads a text word by word; its softmax is
factored: first the class of the next word, then the word in its class. The ``HEAD`` most
frequent words stand in classes of ``WIDTH`` words with a softmax of their own; every other word
belongs to one of ``TAILS`` classes by the hash of its last three bytes, in which its probability
is its smoothed share of the class's count, so that all words of the corpus, and one unseen
word for each class, have a probability. Texts are read in windows; the hidden state is carried from
window to window, so a score is the log-likelihood of the complete text.

Counts cover every training text: one aggregation by word. Words frequent enough that at most
``LOCAL`` words are as frequent (a bound for what tasks hold) are looked up in the task; the
counts of all others come by a join on the word, where no word can be hot, because the hot ones
were answered before.

Training: every training document gives gradient steps once, truncated back-propagation over ``WINDOW``
words with carried state. Documents are dealt by key to shards of about ``SHARD_TOKENS`` words; each shard trains
by itself, in the order of the keys, on a quarter of its documents in each of ``ROUNDS`` rounds, and the
parameters are averaged (weighted by tokens, in the order of the shards) after a round. So the network follows from the
texts alone, not from partitions, batches or executors. Up to ``LANES`` texts are read side by side, fewer where a shard has few. Biases start at the counted shares of
classes and words, so an untrained network scores like the counts.

Edge cases: null and empty texts have one token, the end; a text of any length is scored whole; rows
with null or repeated ids are scored, and learned from, each for itself;
without training texts every word is unseen; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import with_keys
from docloom.llm.words import LOWER, Stored, texts_of
from docloom.runtime import materialize

HEAD, WIDTH, TAILS = 512, 32, 32
CLASSES = HEAD // WIDTH + TAILS
START = HEAD + TAILS  # input of the first step
SIZE = 16
WINDOW = 32
LANES, LEAST_LANES, GROUPS = 384, 64, 12
SHARD_TOKENS = 8_000_000
LONE_TOKENS = LANES * WINDOW
ROUNDS = 4
RATE = 0.01
LOCAL = 200_000
END = b""
READ_WINDOW, READ_TOKENS, READ_ROWS = 64, 3_000_000, 32_768
CACHED = 2048  # states whose class gradients are taken at once, so that they stay in the cache
LN10 = math.log(10)


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % TAILS


# --- the network -----------------------------------------------------------------------------


@dataclass
class Network:
    """Parameters: input rows (gates by word), recurrent matrix, class layer, word layer of the head classes."""

    inputs: np.ndarray  # START + 1, 3 * SIZE
    recur: np.ndarray  # SIZE, 3 * SIZE
    to_class: np.ndarray  # SIZE, CLASSES
    class_bias: np.ndarray
    to_word: np.ndarray  # HEAD // WIDTH, SIZE, WIDTH
    word_bias: np.ndarray  # HEAD // WIDTH, WIDTH

    @classmethod
    def fresh(cls, class_counts: np.ndarray, word_counts: np.ndarray, seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        f = np.float32
        words = word_counts.reshape(HEAD // WIDTH, WIDTH) + 0.5
        return cls(
            rng.normal(0, 0.3, (START + 1, 3 * SIZE)).astype(f), rng.normal(0, 0.3, (SIZE, 3 * SIZE)).astype(f),
            np.zeros((SIZE, CLASSES), f), np.log((class_counts + 0.5) / (class_counts + 0.5).sum()).astype(f),
            np.zeros((HEAD // WIDTH, SIZE, WIDTH), f), np.log(words / words.sum(1, keepdims=True)).astype(f),
        )

    def arrays(self) -> list[np.ndarray]:
        return [self.inputs, self.recur, self.to_class, self.class_bias, self.to_word, self.word_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def filled(self, flat: np.ndarray) -> Network:
        """A network of this shape with other numbers."""
        out, at = [], 0
        for a in self.arrays():
            out.append(flat[at : at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return Network(*out)

    def step(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The state after reading ``ids``; features are rows and texts are columns."""
        u = self._turn @ h
        g = _columns_at(self._columns, ids)
        last = g[2 * SIZE :]
        g, inner = g[: 2 * SIZE], u[2 * SIZE :]
        g += u[: 2 * SIZE]
        np.tanh(g, out=g)  # halves stand in the parameters: the logistic function is (1 + tanh(x / 2)) / 2
        g += 1
        g *= 0.5
        inner *= g[SIZE:]
        inner += last
        n = np.tanh(inner, out=inner)
        out = h - n
        out *= g[:SIZE]
        out += n
        return out

    @cached_property
    def _columns(self) -> np.ndarray:
        halved = self.inputs.T.copy()
        halved[: 2 * SIZE] *= 0.5
        return np.ascontiguousarray(halved)

    @cached_property
    def _turn(self) -> np.ndarray:
        halved = self.recur.T.copy()
        halved[: 2 * SIZE] *= 0.5
        return np.ascontiguousarray(halved)

    def log_probabilities(self, h: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """ln P(class of target | h), plus ln P(word | class, h) for head words; the columns of ``h`` are states."""
        head = targets < HEAD
        classes = np.where(head, targets // WIDTH, targets - HEAD + HEAD // WIDTH)
        logits = self.to_class.T @ h
        logits += self.class_bias[:, None]
        out = logits[classes, np.arange(len(targets))] - _log_sum(logits)
        order = np.flatnonzero(head)
        order = order[np.argsort(classes[order].astype(np.int16), kind="stable")]
        bounds = np.searchsorted(classes[order], np.arange(HEAD // WIDTH + 1))
        inner, places = _columns_at(h, order), targets[order] % WIDTH
        more = np.empty(len(order), h.dtype)
        for c in range(HEAD // WIDTH):
            at = slice(bounds[c], bounds[c + 1])
            if at.start < at.stop:
                logits = self.to_word[c].T @ inner[:, at]
                logits += self.word_bias[c][:, None]
                more[at] = logits[places[at], np.arange(logits.shape[1])] - _log_sum(logits)
        out[order] += more
        return out

    def read(self, texts: list[np.ndarray]) -> np.ndarray:
        """Sum of log-probabilities of every text of token ids, window by window with carried state."""
        order = np.argsort([-len(t) for t in texts], kind="stable")
        lengths = np.array([len(texts[i]) for i in order])
        total = np.zeros(len(texts))
        state = self.step(np.zeros((SIZE, len(texts)), np.float32), np.full(len(texts), START))
        # all texts in a row, longest first, so that a window is one look-up
        flat = np.concatenate([texts[i] for i in order]).astype(np.int64) if len(order) else np.empty(0, np.int64)
        firsts = np.cumsum(lengths) - lengths
        for begin in range(0, int(lengths[0]) if len(lengths) else 0, READ_WINDOW):
            active = int(np.searchsorted(-lengths, -begin))  # texts longer than begin
            width = int(min(READ_WINDOW, lengths[0] - begin))
            counts = np.searchsorted(-lengths[:active], -(begin + np.arange(width)))  # texts that have the word of each step
            targets = [flat[firsts[:c] + begin + t] for t, c in enumerate(counts.tolist())]
            states, h = [], state[:, :active]
            for t, c in enumerate(counts.tolist()):
                h = h[:, :c]
                states.append(h)
                h = self.step(h, targets[t])
            state = h  # of the texts that reach the end of the window
            every, goal = np.concatenate(states, axis=1), np.concatenate(targets)
            owner = np.concatenate([np.arange(c) for c in counts])
            for at in range(0, len(goal), 16_384):
                found = self.log_probabilities(every[:, at : at + 16_384], goal[at : at + 16_384])
                total[:active] += np.bincount(owner[at : at + 16_384], found, minlength=active)
        back = np.empty(len(texts))
        back[order] = total
        return back

    def gradients(self, state: np.ndarray, previous: np.ndarray, block: np.ndarray) -> tuple[float, list[np.ndarray], np.ndarray]:
        """Loss, gradients and last state of a window: rows of ``block`` are steps, -1 ends a lane.

        ``previous`` are the inputs that lead to the first prediction. Lanes are sorted by
        length, so the active ones are always the first.
        """
        width = len(block)
        counts = (block >= 0).sum(1)
        ends = np.cumsum(counts)
        spans = [slice(e - c, e) for e, c in zip(ends, counts)]
        targets = block[block >= 0]  # step by step, as everything below
        ids = np.concatenate([previous[: counts[0]], *(block[t - 1, : counts[t]] for t in range(1, width))])
        # features are rows and lanes are columns, so that every operation runs along whole rows of lanes
        x, kind = _columns_at(np.ascontiguousarray(self.inputs.T), ids), self.recur.dtype
        before, after, cand, kept = (np.empty((SIZE, ends[-1]), kind) for _ in range(4))
        gates, h, turn = np.empty((2 * SIZE, ends[-1]), kind), state.T, np.ascontiguousarray(self.recur.T)
        for t, at in enumerate(spans):
            h = before[:, at] = h[:, : counts[t]]
            u = turn @ h
            g = x[: 2 * SIZE, at] + u[: 2 * SIZE]
            g *= 0.5  # the logistic function as a hyperbolic tangent
            np.tanh(g, out=g)
            g += 1
            g *= 0.5
            gates[:, at], kept[:, at] = g, u[2 * SIZE :]
            n = g[SIZE:] * u[2 * SIZE :]
            n += x[2 * SIZE :, at]
            np.tanh(n, out=n)
            cand[:, at] = n
            h = after[:, at] = n + g[:SIZE] * (h - n)
        loss, d_after, d_class, d_class_bias, d_word, d_word_bias = self._output_gradients(after, targets)
        z, r = gates[:SIZE], gates[SIZE:]
        to_cand, to_z, to_r = (1 - z) * (1 - cand * cand), (before - cand) * z * (1 - z), kept * r * (1 - r)
        d_input, inner = np.empty_like(x), np.empty_like(x)
        carried = np.zeros((SIZE, 0), kind)
        for at in reversed(spans):
            d = d_after[:, at]
            d[:, : carried.shape[1]] += carried
            dn = d * to_cand[:, at]
            d_input[:SIZE, at] = d * to_z[:, at]
            d_input[SIZE : 2 * SIZE, at] = dn * to_r[:, at]
            d_input[2 * SIZE :, at] = dn
            inner[: 2 * SIZE, at] = d_input[: 2 * SIZE, at]
            inner[2 * SIZE :, at] = dn * r[:, at]
            carried = d * z[:, at] + self.recur @ inner[:, at]
        d_inputs, ids = np.empty_like(self.inputs), ids.astype(np.intp)
        for row, values in enumerate(d_input):
            d_inputs[:, row] = np.bincount(ids, values, START + 1)
        return loss, [d_inputs, before @ inner.T, d_class, d_class_bias, d_word, d_word_bias], h.T

    def _output_gradients(self, h: np.ndarray, targets: np.ndarray):
        """Loss and gradients of the softmax layers; the columns of ``h`` are states."""
        head = targets < HEAD
        classes = np.where(head, targets // WIDTH, targets - HEAD + HEAD // WIDTH)
        loss, d_h, d_class, d_class_bias = 0.0, np.empty_like(h), np.zeros_like(self.to_class), np.zeros_like(self.class_bias)
        for low in range(0, len(targets), CACHED):
            own = h[:, low : low + CACHED]
            logits = self.to_class.T @ own
            logits += self.class_bias[:, None]
            p, more = _softmax_loss(logits, classes[low : low + CACHED])
            loss += more
            d_h[:, low : low + CACHED] = self.to_class @ p
            d_class += own @ p.T
            d_class_bias += p.sum(1)
        d_word, d_word_bias = np.zeros_like(self.to_word), np.zeros_like(self.word_bias)
        order = np.flatnonzero(head)
        order = order[np.argsort(classes[order].astype(np.int16), kind="stable")]
        bounds = np.searchsorted(classes[order], np.arange(HEAD // WIDTH + 1))
        inner, places = _columns_at(h, order), targets[order] % WIDTH
        back = np.zeros((SIZE, len(order) + 1), h.dtype)  # the last column is for all that are not in the head
        for c in range(HEAD // WIDTH):
            at = slice(bounds[c], bounds[c + 1])
            if at.start < at.stop:
                logits = self.to_word[c].T @ inner[:, at]
                logits += self.word_bias[c][:, None]
                q, more = _softmax_loss(logits, places[at])
                loss += more
                d_word[c], d_word_bias[c] = inner[:, at] @ q.T, q.sum(1)
                back[:, at] = self.to_word[c] @ q
        place = np.full(len(targets), len(order))
        place[order] = np.arange(len(order))
        d_h += _columns_at(back, place)
        return loss, d_h, d_class, d_class_bias, d_word, d_word_bias


def _columns_at(a: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``a[:, places]``; all places exist, so they need no check, which takes longer than the copy."""
    return a.take(places, axis=1, mode="clip")


def _log_sum(logits: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials of each column; overwrites ``logits``."""
    top = logits.max(0)
    logits -= top
    return top + np.log(np.exp(logits, out=logits).sum(0))


def _softmax_loss(logits: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient (in place of the logits) and loss; columns are cases."""
    at = targets * logits.shape[1] + np.arange(logits.shape[1])
    logits -= logits.max(0)
    p = np.exp(logits, out=logits)
    p /= p.sum(0)
    hit = p.ravel()[at]
    loss = -float(np.log(np.maximum(hit, 1e-30)).sum())
    p.ravel()[at] = hit - 1
    return p, loss


def train(network: Network, texts: list[np.ndarray], rate: float = RATE) -> Network:
    """Adam steps over the texts once: lanes of similar length, windows with carried state.

    Windows of few lanes wait, summed, for the next wide one or until they hold ``LONE_TOKENS`` words: else
    the end of one long text would be as many steps as the same windows of many texts.
    """
    params = network.arrays()
    params = [p.copy() for p in params]
    first, second, steps = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    order = sorted(range(len(texts)), key=lambda i: (-len(texts[i]), i))
    lanes = min(LANES, max(LEAST_LANES, len(order) // GROUPS))
    groups = [order[k : k + lanes] for k in range(0, len(order), lanes)]
    summed, tokens = None, 0

    def step() -> None:
        for p, g_, m, v in zip(params, summed, first, second):
            g_ /= tokens
            m += 0.1 * (g_ - m)
            v += 0.01 * (g_ * g_ - v)
            p -= rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-6)

    for g in np.random.default_rng(1).permutation(len(groups)):
        group = [texts[i] for i in groups[g]]
        state, previous = np.zeros((len(group), SIZE), np.float32), np.full(len(group), START)
        active = group
        for begin in range(0, len(group[0]), WINDOW):
            active = [t for t in active if len(t) > begin]
            width = min(WINDOW, len(group[0]) - begin)
            block = np.full((width, len(active)), -1, np.int64)
            for k, t in enumerate(active):
                part = t[begin : begin + width]
                block[: len(part), k] = part
            now = Network(*params)
            _, grads, state = now.gradients(state[: len(active)], previous[: len(active)], block)
            summed = grads if summed is None else [a + b for a, b in zip(summed, grads)]
            counts = (block >= 0).sum(1)
            tokens += int(counts.sum())
            previous = block[-1, : counts[-1]]
            if 2 * len(active) >= LEAST_LANES or tokens >= LONE_TOKENS:
                steps += 1
                step()
                summed, tokens = None, 0
    if tokens:
        steps += 1
        step()
    return Network(*params)


# --- counts ----------------------------------------------------------------------------------


def tokens_of(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased, then the end."""
    words = text.translate(LOWER).split()
    words.append(END)
    return words


def count_words(texts: DataFrame) -> DataFrame:
    """(word binary, n) over one column of texts: combined in the task, then one aggregation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()

        for batch in batches:
            for text in texts_of(batch.column(0)):
                seen.update(tokens_of(text))
                if len(seen) > 400_000:
                    yield from out()
        yield from out()

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _spark_tail_class() -> Column:
    return F.crc32(F.expr("CASE WHEN length(word) > 3 THEN substring(word, length(word) - 2, 3) ELSE word END")) % TAILS


@dataclass
class Lexicon:
    """What tasks know about words; every part has a fixed bound."""

    words: list[bytes]  # at most LOCAL, the most frequent first; the first HEAD are the head
    counts: np.ndarray
    total: int  # N
    distinct: int  # V
    tail_mass: np.ndarray  # for each tail class: count of its words, plus distinct ones, plus 1
    class_counts: np.ndarray

    def ids(self) -> np.ndarray:
        """Token id of each local word."""
        return np.array([k if k < HEAD else HEAD + tail_class(w) for k, w in enumerate(self.words)], np.int64)


def lexicon(counts: DataFrame, local: int = LOCAL) -> Lexicon:
    """Collect the frequent words: the cut is the smallest count that at most ``local`` words reach."""
    by_count = counts.groupBy(_rounded("n").alias("least")).agg(F.count("*").alias("k"))  # a few thousand rows at most
    kept, cut = 0, None
    for row in sorted(by_count.collect(), key=lambda r: -r["least"]):
        if kept + row["k"] > local:
            break
        kept, cut = kept + row["k"], row["least"]
    rows = counts.where(F.col("n") >= cut).collect() if cut is not None else []
    rows = sorted(((bytes(r["word"]), r["n"]) for r in rows), key=lambda r: (-r[1], r[0]))
    tails = counts.groupBy(_spark_tail_class().alias("t")).agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()
    mass, kinds = np.zeros(TAILS), np.zeros(TAILS)
    for r in tails:
        mass[r["t"]], kinds[r["t"]] = r["n"], r["k"]
    total, distinct = int(mass.sum()), int(kinds.sum())
    head = rows[:HEAD]
    for word, n in head:
        mass[tail_class(word)] -= n
        kinds[tail_class(word)] -= 1
    class_counts = np.concatenate([np.zeros(HEAD // WIDTH), mass])
    for k, (_, n) in enumerate(head):
        class_counts[k // WIDTH] += n
    return Lexicon([w for w, _ in rows], np.array([n for _, n in rows], np.int64), total, distinct, mass + kinds + 1, class_counts)


def _rounded(name: str) -> Column:
    """The count with all but its seven leading bits cleared."""
    shift = F.greatest(F.length(F.bin(name)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", F.col(name), shift), shift)


class _Lookup(dict):
    def __missing__(self, word):
        return -1


# --- Spark jobs ------------------------------------------------------------------------------


def _learner(start, rate: float):
    """Trains on the rows (shard, deal, ids) of one shard from the broadcast parameters; returns its parameters and weight."""

    def learn(table: pa.Table) -> pa.Table:
        own = Network.fresh(np.zeros(CLASSES), np.zeros(HEAD)).filled(start.value)
        ids = table.sort_by("deal").column("ids").combine_chunks()
        part = np.split(ids.flatten().to_numpy(), np.cumsum(ids.value_lengths().to_numpy())[:-1])
        values, weight = train(own, part, rate).flat(), sum(map(len, part))
        return pa.table(
            {
                "shard": pa.array(np.full(len(values), table.column("shard")[0].as_py(), np.int64)),
                "at": pa.array(np.arange(len(values), dtype=np.int32)), "value": pa.array(values.astype(float)),
                "weight": pa.array(np.full(len(values), float(weight))),
            }
        )

    return learn


def fit(texts: DataFrame, words: Lexicon, rounds: int = ROUNDS) -> Network:
    """Train on all rows of (key, text), keys unique: local training in the partitions, averaged after each round."""
    head = words.counts[:HEAD]
    network = Network.fresh(words.class_counts, np.r_[head, np.zeros(HEAD - len(head))])
    if not rounds:
        return network
    known = {w: k for k, w in enumerate(words.words[:HEAD])}

    def to_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, tails = known.get, Stored(lambda end: HEAD + tail_class(end))  # endings are few, words are not
        for batch in batches:
            ids = []
            for text in texts_of(batch.column(1)):
                ids.append(np.array([tails[w[-3:]] if (k := place(w)) is None else k for w in tokens_of(text)], np.int16))
            offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            values = np.concatenate([np.empty(0, np.int16), *ids])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, values)], names=["deal", "ids"])

    spark = texts.sparkSession
    shards = max(1, words.total // SHARD_TOKENS)
    encoded = texts.select(F.xxhash64(texts.columns[0]).alias("deal"), texts.columns[1]).mapInArrow(to_ids, "deal long, ids array<short>")
    # dealt by key, so that copies of a text spread; the same shards in every round
    encoded = encoded.withColumns({"shard": F.pmod(F.shiftright("deal", 8), F.lit(shards)), "turn": F.pmod("deal", F.lit(rounds))})
    encoded = materialize(encoded.repartition(shards, "shard"), "lm-train")
    for turn in range(rounds):
        learn = _learner(spark.sparkContext.broadcast(network.flat()), RATE * (1 - turn / rounds))
        mine = encoded.where(F.col("turn") == turn).select("shard", "deal", "ids")
        learned = mine.groupBy("shard").applyInArrow(learn, "shard long, at int, value double, weight double")
        # summed in the order of the shards: the same bits on every cluster
        parts = learned.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("shard", "value", "weight"))).alias("p"))
        zero = F.lit(0.0)
        mean = F.aggregate("p", zero, lambda a, x: a + x["value"] * x["weight"]) / F.aggregate("p", zero, lambda a, x: a + x["weight"])
        values = network.flat()
        for row in parts.select("at", mean.alias("value")).collect():  # as many rows as parameters
            values[row["at"]] = row["value"]
        network = network.filled(values)
    return network


def score_texts(texts: DataFrame, words: Lexicon, network: Network) -> DataFrame:
    """(key, text) to (key, n_tokens, local_log, local_known, net_score, rest, times).

    ``rest`` are the distinct words of a text that the task does not know, ``times`` how
    often they occur. ``local_log`` sums log10(count + 1) over known words, ``local_tail`` over those
    that are not in the head; ``net_score`` is all of log10 P but for the counts of tail words.
    """
    shared = texts.sparkSession.sparkContext.broadcast((words.words, words.counts, words.ids(), words.tail_mass, network.arrays()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts, id_of, tail_mass, arrays = shared.value
        place = _Lookup(zip(names, range(len(names)))).__getitem__
        logs, own = np.log10(counts + 1.0), Network(*arrays)
        in_tail = np.where(id_of >= HEAD, logs, 0.0)
        tail_log = np.zeros(START)
        tail_log[HEAD:] = np.log10(tail_mass)
        keys, rows, ids, size = [], [], [], 0

        def out():
            nets = own.read(ids) / LN10
            nets -= [tail_log[i].sum() for i in ids]
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(keys), pa.array(columns[0], pa.int64()), pa.array(columns[1]), pa.array(columns[2]),
                    pa.array(columns[3], pa.int64()), pa.array(nets), pa.array(columns[4], pa.list_(pa.binary())), pa.array(columns[5], pa.list_(pa.int32())),
                ],
                names=["key", "n_tokens", "local_log", "local_tail", "local_known", "net_score", "rest", "times"],
            )

        for batch in batches:
            for k, text in enumerate(texts_of(batch.column(1))):
                tokens = tokens_of(text)
                at = np.fromiter(map(place, tokens), np.int64, len(tokens))
                local = at >= 0
                found = at[local]
                token_ids = np.empty(len(tokens), np.int16)
                token_ids[local] = id_of[found]
                rest: Counter = Counter()
                if len(found) < len(tokens):
                    unknown = [tokens[i] for i in np.flatnonzero(~local)]
                    rest.update(unknown)
                    token_ids[~local] = [HEAD + tail_class(w) for w in unknown]
                keys.append(batch.column(0).slice(k, 1))
                rows.append((len(tokens), float(logs[found].sum()), float(in_tail[found].sum()), len(found), list(rest), list(rest.values())))
                ids.append(token_ids)
                size += len(tokens)
                if size >= READ_TOKENS or len(rows) >= READ_ROWS:
                    yield from out()
                    keys, rows, ids, size = [], [], [], 0
        if rows:
            yield from out()

    kind = texts.schema["key"].dataType.simpleString()
    return texts.select("key", "text").mapInArrow(
        run,
        f"key {kind}, n_tokens long, local_log double, local_tail double, local_known long, net_score double, "
        "rest array<binary>, times array<int>",
    )


def score_documents(docs: DataFrame, learned: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score); ``learned`` marks the training rows."""
    keyed, key = with_keys(docs.select(id_col, text_col, learned.alias("_l_learned")), id_col)
    counts = materialize(count_words(keyed.where("_l_learned").select(text_col)), "lm-counts")
    words = lexicon(counts)
    network = fit(keyed.where("_l_learned").select(key, text_col), words)
    named = keyed.select(F.col(key).alias("key"), F.col(text_col).alias("text"))
    scored = materialize(score_texts(named, words, network), "lm-scores")
    pairs = scored.select("key", F.explode(F.arrays_zip("rest", "times")).alias("p")).select(
        "key", F.col("p.rest").alias("word"), F.col("p.times").alias("times")
    )
    # words that are not local; those missing from the counts add log10(1) and are not known
    least = int(words.counts[-1]) if len(words.counts) else None
    others = counts.where(F.col("n") < least) if least is not None else counts
    joined = pairs.join(others, "word").groupBy("key").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rest_log"), F.sum("times").alias("rest_known")
    )
    per_token = math.log10(words.total + words.distinct + 1)
    rest = F.coalesce("rest_log", F.lit(0.0))
    out = scored.drop("rest", "times").join(joined.withColumnRenamed("key", "_l_key"), F.col("key") == F.col("_l_key"), "left")
    out = out.select(
        "key", "n_tokens", (F.col("local_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("local_log") + rest - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("net_score") + F.col("local_tail") + rest).alias("score"),
    )
    ids = keyed.select(F.col(key).alias("key"), F.col(id_col).alias("_l_id"), (~F.col("_l_learned")).alias("held_out"))
    return out.join(ids, "key").select(
        F.col("_l_id").alias(id_col), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
