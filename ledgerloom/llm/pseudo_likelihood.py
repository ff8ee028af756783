"""Masked pseudo-likelihood of documents under a bidirectional window network.

Each word is predicted from the words on both sides of it, itself masked, and a document's score is the sum of the
logarithms of these conditional probabilities. Word counts of the whole corpus, summed by Spark, fix the outputs: the
most frequent words, and classes of the others by hash. A word of a class has its class's probability times its own share of
the counts of that class. Counts of the next most frequent words are broadcast, those of all others stay a Spark table and are joined. The network
(a vector per word and position, their sum, tanh, a softmax over groups of outputs and one inside the group) is trained in numpy inside tasks: each task runs gradient
steps over the documents of its partition, and the means of their weights begin the next round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batches, cut, signed, text_batches, word_hashes

#: Words with an output each at most, classes of all others, words on each side, and size of the vectors.
FREQUENT, CLASSES, SIDE, WIDTH = 1920, 128, 3, 24
#: Outputs of a group: a word costs one softmax over the groups and one over its own.
GROUP = 64
#: Words, at most, whose counts are broadcast; counts of the others are joined.
KNOWN = 1 << 20
#: Bits of a broadcast filter of the words to be joined; what it lets through by chance finds no count.
FILTER_BITS = 26
_CHUNK = 16384
_STEP = 8192  # words of a gradient step


@dataclass(frozen=True)
class Vocabulary:
    """Hashes of the frequent words, sorted, their ranks by count, the log of each class's count, each output's share, and counts of known words.

    known has all words met at least `least` times, sorted, and log_known the logs of their counts.
    """

    frequent: np.ndarray
    rank: np.ndarray
    log_class: np.ndarray
    share: np.ndarray
    known: np.ndarray
    log_known: np.ndarray
    least: int

    @property
    def size(self) -> int:
        return FREQUENT + CLASSES

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        other = FREQUENT + (hashes % np.uint64(CLASSES)).astype(np.int64)
        if not len(self.frequent):
            return other
        at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
        return np.where(self.frequent[at] == hashes, self.rank[at], other)

    def log_counts(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log of each word's count, 0 where it is not known, and whether it is."""
        if not len(self.known):
            return np.zeros(len(hashes)), np.zeros(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        there = self.known[at] == hashes
        return np.where(there, self.log_known[at], 0.0), there

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids and log_counts, found once for each different word."""
        words, at = np.unique(hashes, return_inverse=True)
        logs, there = self.log_counts(words)
        return self.ids(words)[at], logs[at], there[at]


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(word, n): counts of all words of all documents by hash; summed inside tasks before the shuffle."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, n = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        for frame in batches(frames, 256):
            own, counts = np.unique(word_hashes(frame["t"], lower=True)[0], return_counts=True)
            words, at = np.unique(np.concatenate([words, own]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([n, counts]), minlength=len(words)).astype(np.int64)
            if len(words) > 1_000_000:
                yield pd.DataFrame({"word": signed(words), "n": n})
                words, n = words[:0], n[:0]
        yield pd.DataFrame({"word": signed(words), "n": n})

    return cut(docs.select(F.col(text).alias("t")).mapInPandas(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))


def _packed(*columns: str):
    """Columns of 64-bit numbers as bytes, one row for each frame."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({c: [frame[c].to_numpy(dtype=np.int64).tobytes()] for c in columns})

    return run


def vocabulary(docs: DataFrame, text: str, counts: DataFrame | None = None) -> Vocabulary:
    counts = count_words(docs, text) if counts is None else counts
    top = [(r["word"], r["n"]) for r in counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()]
    hashes = np.array([w for w, _ in top], dtype=np.int64).view(np.uint64)
    rank = np.argsort(hashes)
    share = np.ones(FREQUENT + CLASSES)
    share[: len(top)] += [n for _, n in top]
    # the unsigned hash modulo a power of two is its last bits
    of_class = F.col("word").bitwiseAND(F.lit(CLASSES - 1)).alias("c")
    of_classes = np.zeros(CLASSES, dtype=np.int64)
    for r in counts.groupBy(of_class).agg(F.sum("n").alias("n")).collect():
        of_classes[r["c"]] = r["n"]
    for word, n in top:
        of_classes[word & (CLASSES - 1)] -= n
    share[FREQUENT:] += of_classes
    words, least = 0, None
    for r in counts.where("n > 1").groupBy("n").count().orderBy(F.desc("n")).collect():
        words += r["count"]
        if words > KNOWN:
            break
        least = r["n"]
    else:
        least = 2  # a word met once has log 0 and need not be known

    known = counts.where(F.col("n") >= (least or 1 << 62)).mapInPandas(_packed("word", "n"), "word binary, n binary").collect()
    known_words = np.frombuffer(b"".join(r["word"] for r in known), dtype=np.uint64)
    met = np.frombuffer(b"".join(r["n"] for r in known), dtype=np.int64)
    order = np.argsort(known_words)
    log_known = np.log(met.astype(np.float64))[order]
    return Vocabulary(hashes[rank], rank, np.log(np.maximum(of_classes, 1)), share / share.sum(), known_words[order], log_known, least or 1 << 62)


def _logits(vectors: np.ndarray, bias: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Logits of each row of h less their largest, as a column: sums down columns run along rows of memory."""
    logits = vectors.T @ h.T
    logits += bias[:, None]
    logits -= logits.max(axis=0)
    return logits


def _shares(vectors: np.ndarray, bias: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Softmax of each row of h, as a column."""
    p = _logits(vectors, bias, h)
    np.exp(p, out=p)
    p /= p.sum(axis=0)
    return p


def _log_share(vectors: np.ndarray, bias: np.ndarray, h: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The log of the softmax of each row of h at one place."""
    logits = _logits(vectors, bias, h)
    shares = logits.astype(np.float32)
    sums = np.exp(shares, out=shares).sum(axis=0, dtype=np.float64)
    return logits[own, np.arange(len(own))] - np.log(sums)


def _by_group(target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order in which the words of a group stand together, and each group met with its stretch of that order."""
    groups = (target // GROUP).astype(np.int16)
    edges = np.concatenate(([0], np.cumsum(np.bincount(groups)))).tolist()
    return np.argsort(groups, kind="stable"), [(g, slice(a, b)) for g, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]


class Network:
    """inputs[p, w]: vector of word w at position p of the window, the last row standing for no word; gates: vectors and biases of groups of
    outputs; outputs: of the words of each group."""

    def __init__(self, inputs: np.ndarray, gates: np.ndarray, gate_bias: np.ndarray, outputs: np.ndarray, bias: np.ndarray):
        self.inputs, self.gates, self.gate_bias, self.outputs, self.bias = inputs, gates, gate_bias, outputs, bias

    @staticmethod
    def start(words: Vocabulary, seed: int = 8) -> "Network":
        """Small random vectors, and biases that give each output its share in the corpus."""
        size, groups = words.size, words.size // GROUP
        rng = np.random.default_rng(seed)
        share = words.share.reshape(groups, GROUP)
        of_group = share.sum(axis=1)

        def vectors(*shape: int) -> np.ndarray:
            return rng.normal(scale=0.1, size=shape).astype(np.float32)

        biases = np.log(of_group).astype(np.float32), np.log(share / of_group[:, None]).astype(np.float32)
        return Network(vectors(2 * SIDE, size + 1, WIDTH), vectors(WIDTH, groups), biases[0], vectors(groups, WIDTH, GROUP), biases[1])

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.gates, self.gate_bias, self.outputs, self.bias]

    def weights(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    def load(self, flat: np.ndarray) -> "Network":
        cuts = np.split(flat, np.cumsum([x.size for x in self.parts()])[:-1])
        return Network(*[x.reshape(own.shape).copy() for x, own in zip(cuts, self.parts())])

    def hidden(self, context: np.ndarray) -> np.ndarray:
        total = self.inputs[0].take(context[0], axis=0)
        row = np.empty_like(total)
        for p in range(1, 2 * SIDE):
            total += self.inputs[p].take(context[p], axis=0, out=row, mode="clip")
        return np.tanh(total, out=total)

    def double(self) -> "Network":
        """The same with outputs in double precision, with which a word's place in a batch doesn't show in its rounded score."""
        return Network(self.inputs, *[x.astype(np.float64) for x in self.parts()[1:]])

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        order, stretches = _by_group(target)
        h, target = self.hidden(context[:, order]).astype(self.gates.dtype), target[order]
        logs = _log_share(self.gates, self.gate_bias, h, target // GROUP)
        for g, own in stretches:
            logs[own] += _log_share(self.outputs[g], self.bias[g], h[own], target[own] % GROUP)
        out = np.empty_like(logs)
        out[order] = logs
        return out

    def step(self, context: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One gradient step; what few rows say of a group or of a word moves it less."""
        order, stretches = _by_group(target)
        context, target = context[:, order], target[order]
        h = self.hidden(context)
        p = _shares(self.gates, self.gate_bias, h)
        p[target // GROUP, np.arange(len(target))] -= 1
        back = p.T @ self.gates.T
        p *= np.float32(rate / len(target))
        self.gates -= h.T @ p.T
        self.gate_bias -= p.sum(axis=1)
        for g, rows in stretches:
            own, words = h[rows], target[rows] % GROUP
            p = _shares(self.outputs[g], self.bias[g], own)
            p[words, np.arange(len(words))] -= 1
            back[rows] += p.T @ self.outputs[g].T
            p *= np.float32(rate / (len(words) + 32))
            self.outputs[g] -= own.T @ p.T
            self.bias[g] -= p.sum(axis=1)
        back *= 1 - h * h
        # each component of a vector is a bin, so sums need no order of the words
        weights, bins = back.ravel().astype(np.float64), np.arange(WIDTH)
        for side in range(2 * SIDE):
            vectors = self.inputs[side]
            words = context[side].astype(np.int64)
            moved = np.bincount((words[:, None] * WIDTH + bins).ravel(), weights, vectors.size).reshape(vectors.shape)
            moved *= (rate / (np.bincount(words, minlength=len(vectors)) + 4))[:, None]
            vectors -= moved.astype(np.float32)


def windows(ids: np.ndarray, offsets: np.ndarray, none: int) -> np.ndarray:
    """For each word, a column of the ids of SIDE words before and after it in its document, `none` where there is no word."""
    n = len(ids)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    first, last = offsets[:-1][doc], offsets[1:][doc]
    out = np.full((2 * SIDE, n), none, dtype=np.int16)
    at = np.arange(n)
    for k, shift in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        there = at + shift
        ok = (there >= first) & (there < last)
        out[k, ok] = ids[there[ok]]
    return out


def train(docs: DataFrame, text: str, doc_id: str, words: Vocabulary, rounds: int = 3, rate: float = 2.0, slices: int = 16) -> Network:
    """Rounds of gradient steps over all documents, in place in the partitions of docs.

    Documents are dealt to the rounds by hash of id and text, so each trains once. A partition sends how far its weights, of fixed size,
    moved, times the words that moved them: for a vector of a word at a position those met there, else all. Sums by slice
    come to the driver. Weights depend on how docs is dealt to partitions.
    """
    spark = docs.sparkSession
    own = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("t"), F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(rounds)).alias("fold"))
    network = Network.start(words)
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((network, words))

        def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            start, known = shared.value
            own, n, met = start.load(start.weights()), 0, np.zeros((2 * SIDE, known.size + 1), dtype=np.int64)
            for frame in batches(frames, 256):
                hashes, offsets = word_hashes(frame["t"], lower=True)
                ids = known.look_up(hashes)[0]
                context = windows(ids, offsets, known.size)
                order = np.random.default_rng((turn, len(ids))).permutation(len(ids))
                for at in range(0, len(order), _STEP):
                    rows = order[at : at + _STEP]
                    own.step(context[:, rows], ids[rows], rate / (1 + turn))
                for k in range(2 * SIDE):
                    met[k] += np.bincount(context[k], minlength=known.size + 1)
                n += len(ids)
            if n:
                each = np.concatenate([np.repeat(met.ravel(), WIDTH), np.full(len(own.weights()) - own.inputs.size, n)])
                moved = np.concatenate([(own.weights() - start.weights()) * each, met.ravel(), [n]]).astype(np.float32)
                part = TaskContext.get().partitionId()
                yield pd.DataFrame([(k, part, x.tobytes()) for k, x in enumerate(np.array_split(moved, slices))], columns=["slice", "part", "moved"])

        def add(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("part")
            total = sum(np.frombuffer(x, dtype=np.float32).astype(np.float64) for x in frame["moved"])
            return pd.DataFrame({"slice": frame["slice"].iloc[:1], "moved": [total.tobytes()]})

        learnt = own.where(F.col("fold") == turn).mapInPandas(learn, "slice int, part int, moved binary")
        got = sorted(learnt.groupBy("slice").applyInPandas(add, "slice int, moved binary").collect())
        if not got:
            continue
        total = np.concatenate([np.frombuffer(r["moved"], dtype=np.float64) for r in got])
        flat, met = network.weights(), 2 * SIDE * (words.size + 1)
        moved, met, n = total[: len(flat)], total[len(flat) : len(flat) + met], total[-1]
        each = np.concatenate([np.repeat(met, WIDTH), np.full(len(flat) - network.inputs.size, n)])
        network = network.load((flat + moved / np.maximum(each, 1)).astype(np.float32))
    return network


def score_texts(texts: pd.Series, network: Network, words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Number of words and sum of log probabilities of each text; words that are not known count as met once."""
    hashes, offsets = word_hashes(texts, lower=True)
    ids, logs, _ = words.look_up(hashes)
    context = windows(ids, offsets, words.size)
    each = np.empty(len(ids))
    for at in range(0, len(ids), _CHUNK):
        each[at : at + _CHUNK] = network.log_probabilities(context[:, at : at + _CHUNK], ids[at : at + _CHUNK])
    rare = ids >= FREQUENT
    each[rare] += logs[rare] - words.log_class[ids[rare] - FREQUENT]
    sums = np.concatenate([[0.0], np.cumsum(each)])
    return np.diff(offsets), np.round(sums[offsets[1:]] - sums[offsets[:-1]], 6)


def unknown_counts(docs: DataFrame, text: str, words: Vocabulary, counts: DataFrame) -> DataFrame:
    """(h1, h2, unknown): by hash of text, what the counts of words that are not known add to its score, in units of 1e-9.

    No such word is met more than words.least times, so none is hot. Words met once add nothing, and a filter of fixed size keeps nearly
    all of them from being sent.
    """
    rest = counts.where((F.col("n") > 1) & (F.col("n") < words.least))
    bit = F.col("word").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    sixty_four = rest.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(word & 63 as int)))").alias("bits"))
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    for r in sixty_four.mapInPandas(_packed("at", "bits"), "at binary, bits binary").collect():
        bits[np.frombuffer(r["at"], dtype=np.int64)] = np.frombuffer(r["bits"], dtype=np.int64)

    def tail(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames, 256):
            hashes, offsets = word_hashes(frame["t"], lower=True)
            ids, _, there = words_of.value.look_up(hashes)
            place = (hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
            may_count = bits_of.value[place >> 6] >> (place & 63) & 1 == 1
            wanted = np.flatnonzero((ids >= FREQUENT) & ~there & may_count)
            at, word = np.repeat(np.arange(len(frame)), np.diff(offsets))[wanted], hashes[wanted]
            order = np.lexsort((word, at))
            at, word = at[order], word[order]
            first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (word[1:] != word[:-1])))[: len(at)])
            own = at[first]
            times = np.diff(first, append=len(at))
            yield pd.DataFrame({"h1": frame["h1"].to_numpy()[own], "h2": frame["h2"].to_numpy()[own], "word": signed(word[first]), "times": times})

    words_of, bits_of = (docs.sparkSession.sparkContext.broadcast(x) for x in (words, bits))
    own = docs.select(F.col(text).alias("t"), *text_hashes(text)).mapInPandas(tail, "h1 long, h2 long, word long, times long")
    own = own.repartition("word").distinct()  # dealt by word for the join too
    return own.join(rest, "word").groupBy("h1", "h2").agg(F.sum(F.round(F.col("times") * F.ln("n") * 1e9).cast("long")).alias("unknown"))


def text_hashes(text: str) -> list[Column]:
    return [F.xxhash64(F.col(text)).alias("h1"), F.xxhash64(F.lit("again"), F.col(text)).alias("h2")]


def score_pseudo_likelihood(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of docs with n_words, score (sum of log probabilities of its words) and mean_score (null without words).

    Null and empty texts have no words and score 0. Whole texts count and are scored. Repeated rows get equal scores. An
    empty table gives an empty result. Columns of docs with these names are replaced. All documents train.
    """
    text_batches(docs.sparkSession)
    counts = count_words(docs, text)
    words = vocabulary(docs, text, counts)
    model = docs.sparkSession.sparkContext.broadcast((train(docs, text, doc_id, words).double(), words))

    @F.pandas_udf("struct<n_words:long,score:double>")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            parts = [score_texts(batch.iloc[i : i + 256], *model.value) for i in range(0, len(batch), 256)]
            yield pd.DataFrame({"n_words": np.concatenate([p[0] for p in parts]), "score": np.concatenate([p[1] for p in parts])})

    scored = docs.withColumn("__scored", score(F.col(text)))
    total = F.col("__scored.score")
    if words.least > 2:
        h1, h2 = text_hashes(text)
        unknown = unknown_counts(docs, text, words, counts).select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), F.col("unknown").alias("__unknown"))
        scored = scored.withColumns({"__h1": h1, "__h2": h2}).join(unknown, ["__h1", "__h2"], "left")
        total = F.round(total + F.coalesce("__unknown", F.lit(0)) / 1e9, 6)
    return (
        scored.withColumns({"n_words": F.col("__scored.n_words"), "score": total})
        .withColumn("mean_score", F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")))
        .drop("__scored", "__h1", "__h2", "__unknown")
    )
