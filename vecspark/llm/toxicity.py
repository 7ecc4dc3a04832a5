"""Toxicity scores from subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (3 to 6, with border marks) and itself, hashed into BUCKETS
rows of an embedding table.  The vectors of a word are averaged, the words of a passage (WINDOW words, a
new one every STRIDE words; repeats of a word and missing words count as zero vectors) are averaged, and a
linear softmax turns the average into two classes.  The
score of a text is that of its most toxic passage, so a few words count the same in long and short texts, and
unseen spellings are scored by the n-grams they share with known ones.

Training runs in one task over a bounded sample, so that neither texts nor training state visit the driver: at most ``toxic`` texts with the label and ``other`` without
it, of at most ``sample_chars`` characters each, those with the smallest hashes of their ids.  Every text contributes its
currently most toxic passage, at first by the log odds of its subwords; embeddings and softmax are updated
together (Adam).  For scoring, the table
is multiplied with the softmax weights once, so a task needs one number per bucket, and words met before are
looked up.  Every text is scored whole.

Defined cases: null and empty texts, and texts without word characters, get the score of the bias alone;
null labels are not learned from; of several labels of one id the larger counts; without both classes in the
sample every text gets the smoothed share of the label; repeated rows get equal scores; an empty
table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.llm.registry import free_name
from vecspark.session import materialize

GRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 18
DIMENSIONS = 12
WINDOW, STRIDE = 16, 8
EPOCHS, BATCH, RATE, DECAY, START = 18, 256, 0.05, 1e-6, 2.0
SAMPLE_TOXIC, SAMPLE_OTHER, SAMPLE_CHARS = 2000, 8000, 20_000
CHUNK = 1 << 14
CACHED_WORDS = 1 << 17
GROUP_CHARS = 1 << 20
WORD = re.compile(r"\w+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def subwords(words: list[str], chunk: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all n-grams of all words, offsets by word)."""
    parts = [_subwords(words[lo:lo + chunk]) for lo in range(0, len(words), chunk)]
    if not parts:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([[0], np.cumsum(np.concatenate([p[1] for p in parts]))])


def _subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, how many each word has)."""
    marked = [f"<{w}>" for w in words]
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(m) for m in marked], np.int64)
    ends = np.cumsum(sizes)
    word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    left = ends[word] - np.arange(len(points))  # characters up to the end of the word
    rolled, owner, value = np.zeros(len(points), np.uint64), [], []
    for n in range(1, max(GRAMS) + 1):
        rolled = rolled[:len(points) - n + 1] * np.uint64(1099511628211) + points[n - 1:]
        if n in GRAMS:
            whole = np.flatnonzero(left[:len(rolled)] >= n)
            owner.append(word[whole])
            value.append(_bucket(rolled[whole] + np.uint64(n)))
    powers = np.cumprod(np.full(int(sizes.max()), 6364136223846793005, np.uint64))
    at = np.arange(len(points)) - np.repeat(ends - sizes, sizes)
    owner.append(np.arange(len(words), dtype=np.int32))
    value.append(_bucket(np.add.reduceat(points * powers[at], ends - sizes)))
    owner, value = np.concatenate(owner), np.concatenate(value)
    return value[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


def _bucket(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MULTIPLIER
    return ((x ^ (x >> np.uint64(32))) & np.uint64(BUCKETS - 1)).astype(np.int32)


def segment_means(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(1, np.diff(offsets))


def passages(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first passage of every text) over the joined words of texts with ``counts`` words."""
    begin = np.cumsum(counts) - counts
    number = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    first = np.concatenate([[0], np.cumsum(number)])
    text = np.repeat(np.arange(len(counts)), number)
    at = np.minimum((np.arange(first[-1]) - first[text]) * STRIDE, np.maximum(0, counts[text] - WINDOW))
    return begin[text] + at, begin[text] + np.minimum(at + WINDOW, counts[text]), first


def first_mentions(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """False for words that the same text has within the WINDOW words before."""
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.argsort(words, kind="stable")
    near = np.zeros(len(words), bool)
    if len(words):
        here, before = order[1:], order[:-1]
        near[here] = (words[here] == words[before]) & (text[here] == text[before]) & (here - before < WINDOW)
    return ~near


def _rows_of(features: np.ndarray, bounds: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of some words, offsets by word)."""
    size = bounds[words + 1] - bounds[words]
    at = np.concatenate([[0], np.cumsum(size)])
    return features[np.arange(at[-1]) - np.repeat(at[:-1] - bounds[words], size)], at


def _passage_scores(word_scores: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(word_scores)])
    return (total[end] - total[start]) / WINDOW


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """What scoring needs: the logit difference of every bucket and of the bias."""

    def __init__(self, buckets: np.ndarray, bias: float):
        self.buckets, self.bias = buckets.astype(np.float32), float(bias)


def _log_odds(toxic: np.ndarray, other: np.ndarray, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where training starts from: how much more often the words of a bucket are in labelled texts, shrunk for rare words."""
    odds = np.log((toxic + 0.5) / (toxic.sum() + 1)) - np.log((other + 0.5) / (other.sum() + 1))
    uses = toxic + other
    total, weighted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for lo in range(0, len(uses), CHUNK):
        hi = min(lo + CHUNK, len(uses))
        own, size = features[bounds[lo]:bounds[hi]], np.diff(bounds[lo:hi + 1])
        total += np.bincount(own, np.repeat(uses[lo:hi], size), minlength=BUCKETS)
        weighted += np.bincount(own, np.repeat(odds[lo:hi] * uses[lo:hi] ** 2 / (uses[lo:hi] + 5.0), size), minlength=BUCKETS)
    return weighted / np.maximum(1, total)


def _word_scores(buckets: np.ndarray, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The mean bucket score of every word, a chunk of words at a time."""
    out = np.empty(len(bounds) - 1, np.float32)
    for lo in range(0, len(out), CHUNK):
        hi = min(lo + CHUNK, len(out))
        out[lo:hi] = segment_means(buckets[features[bounds[lo]:bounds[hi]]], bounds[lo:hi + 1] - bounds[lo])
    return out


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        return Model(np.zeros(BUCKETS), float(np.log(share / (1 - share))))
    numbers: dict[str, int] = {}
    docs = [np.array([numbers.setdefault(w, len(numbers)) for w in words_of(t)], np.int32) for t in texts]
    counts, flat = np.array([len(d) for d in docs], np.int64), np.concatenate(docs)
    features, bounds = subwords(list(numbers))
    toxic, other = np.zeros(len(numbers)), np.zeros(len(numbers))
    for doc, label in zip(docs, y):
        (toxic if label else other)[np.unique(doc)] += 1
    del docs, numbers
    counted = first_mentions(flat, counts)
    start, end, first = passages(counts)
    passage_text = np.repeat(np.arange(len(counts), dtype=np.int32), np.diff(first))
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.log([1 - y.mean(), y.mean()])
    table[:, 0] = _log_odds(toxic, other, features, bounds)
    weights[0] = [-START, START]
    values, moments = [table, weights, bias], [(np.zeros_like(v), np.zeros_like(v)) for v in (table, weights, bias)]

    def adam(which: int, grad: np.ndarray, rows=slice(None)) -> None:
        m, v = moments[which]
        m[rows] = 0.9 * m[rows] + 0.1 * grad
        v[rows] = 0.99 * v[rows] + 0.01 * grad**2
        values[which][rows] -= RATE * m[rows] / (np.sqrt(v[rows]) + 1e-8)

    for _ in range(EPOCHS):
        # The most toxic passage of every text under the current model.
        by_word = _word_scores(table @ (weights[:, 1] - weights[:, 0]), features, bounds)
        scores = _passage_scores(by_word[flat] * counted, start, end)
        top = np.flatnonzero(scores == np.maximum.reduceat(scores, first[:-1])[passage_text])
        best = top[np.searchsorted(passage_text[top], np.arange(len(counts)))]
        order = rng.permutation(len(counts))
        for lo in range(0, len(order), BATCH):
            pick = order[lo:lo + BATCH]
            s, size = start[best[pick]], (end - start)[best[pick]]
            owner = np.repeat(np.arange(len(pick)), size)
            at = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(s, size)
            owner, at = owner[counted[at]], at[counted[at]]
            words, number = np.unique(flat[at], return_inverse=True)
            used, cuts = _rows_of(features, bounds, words)
            buckets, used = np.unique(used, return_inverse=True)
            rows, direction = table[buckets], weights[:, 1] - weights[:, 0]
            word_scores = segment_means((rows @ direction)[used], cuts)
            logits = np.bincount(owner, word_scores[number], minlength=len(pick)) / WINDOW + bias[1] - bias[0]
            wrong = (_sigmoid(logits) - y[pick]) / len(pick)
            # Back through the averages: passage -> words -> n-grams.
            grams = np.diff(cuts)
            word_grad = np.bincount(number, wrong[owner] / WINDOW, minlength=len(words)) / grams
            bucket_grad = np.bincount(used, np.repeat(word_grad, grams), minlength=len(buckets)).astype(np.float32)
            toward = rows.T @ bucket_grad
            adam(0, np.outer(bucket_grad, direction) + DECAY * rows, buckets)
            adam(1, np.stack([-toward, toward], axis=1))
            adam(2, np.array([-wrong.sum(), wrong.sum()]))
    return Model(table @ (weights[:, 1] - weights[:, 0]), bias[1] - bias[0])


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.values = np.zeros(0)

    def score(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > CACHED_WORDS:
            self._forget()
        docs = [words_of(t) for t in texts]
        counts = np.array([len(d) for d in docs], np.int64)
        flat = [w for d in docs for w in d]
        fresh = [w for w in set(flat) if w not in self.known]
        if fresh:
            features, bounds = subwords(fresh)
            for w in fresh:
                self.known[w] = len(self.known)
            self.values = np.concatenate([self.values, segment_means(self.model.buckets[features], bounds)])
        number = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        word_scores = self.values[number] * first_mentions(number, counts)
        start, end, first = passages(counts)
        logits = np.maximum.reduceat(_passage_scores(word_scores, start, end), first[:-1]) if len(docs) else np.zeros(0)
        return _sigmoid(logits + self.model.bias)


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, toxic: int, other: int,
                    sample_chars: int) -> DataFrame:
    """(_h, _t, _y) of at most ``toxic`` + ``other`` texts of at most ``sample_chars`` characters."""
    marks = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        (F.max(label) > 0).cast("int").alias("_y"))
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = marks.filter("_y = 1").orderBy(*order).limit(toxic).unionByName(marks.filter("_y = 0").orderBy(*order).limit(other))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_t")).filter(F.length("_t").between(1, sample_chars))
    return texts.join(F.broadcast(chosen), "_id").orderBy(*order, "_t").limit(toxic + other).select(
        F.xxhash64("_id").alias("_h"), "_t", "_y")


def _train_task(batches):
    """The logit differences of all buckets and of the bias, from all rows of the sample."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held).sort_by([("_h", "ascending"), ("_t", "ascending")])
    labels, texts = table["_y"].to_pylist(), table["_t"].to_pylist()
    del table, held
    model = train(texts, labels)
    yield pa.RecordBatch.from_arrays([pa.array([model.buckets.astype("<f4").tobytes()], pa.binary()), pa.array([model.bias])], ["buckets", "bias"])


def _score_all(scorer: Scorer, texts: list[str | None]) -> np.ndarray:
    """Scores of a batch, a bounded group of texts at a time."""
    texts, out, lo = ["" if t is None else t for t in texts], [np.zeros(0)], 0
    while lo < len(texts):
        hi, held = lo, 0
        while hi < len(texts) and (hi == lo or held + len(texts[hi]) <= GROUP_CHARS):
            held += len(texts[hi])
            hi += 1
        out.append(scorer.score(texts[lo:hi]))
        lo = hi
    return np.concatenate(out)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of every row; only the texts visit Python."""
    shared = docs.sparkSession.sparkContext.broadcast((model.buckets, model.bias))  # plain values: workers need no package

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(Model(*shared.value))
        for batch in batches:
            yield pd.Series(_score_all(scorer, batch.tolist()))

    return docs.withColumn(name, scores(F.col(f"`{text}`")))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more, all columns as they were."""
    name = free_name(docs, "score")
    kept = score(docs, model, text, name).filter(F.col(name) < threshold)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        toxic: int = SAMPLE_TOXIC, other: int = SAMPLE_OTHER, sample_chars: int = SAMPLE_CHARS) -> Model:
    sample = materialize(training_sample(docs, labels, id_col, text, label, toxic, other, sample_chars), "training-sample")
    found = sample.coalesce(1).mapInArrow(_train_task, "buckets binary, bias double").first()
    return train([], []) if found is None else Model(np.frombuffer(found["buckets"], "<f4"), found["bias"])
