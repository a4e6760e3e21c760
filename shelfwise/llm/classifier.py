"""Operator 12, quality classifier: random-indexing word vectors pooled per document, and a two-layer network with calibrated chances."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import mix, slices, workers_see_library
from shelfwise.session import materialize

SAMPLE = 12_000  # expected labelled rows to learn from
VOCABULARY = 8_192  # words with vectors of their own, beside the shapes
LEAST_TEXTS = 5  # sampled texts that such a word is in
DIMENSIONS = 64
NONZERO = 8  # entries of a word's random index
WINDOW = 2  # neighbours on either side that add to a word's vector
OWN = 1.0  # share of a word's own index in its vector
SMOOTH = 1e-3  # a word of this share of the corpus counts half in a document
PRIOR = 6.0  # words of the corpus's mean that are pooled with each document: a short text says little
PAIRS = 1 << 15  # pairs of neighbours that are added up at once
HIDDEN = 32
STEPS, RATE, DECAY = 600, 0.02, 1e-3
CALIBRATE = 5  # one sampled text in so many sets the temperature, the others the weights

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
#: What a word without a vector of its own counts as: its shape.
SHAPES = ("<lower>", "<Title>", "<UPPER>", "<miXed>", "<digits>", "<signs>")
AGAIN = "<again>"  # stands for a token equal to the one before


def tokens_of(text: str) -> list[str]:
    """Runs of letters and digits, and runs of other signs, as they are written."""
    return _TOKEN.findall(text)


def shape_of(token: str) -> str:
    if not token[0].isalnum():
        return "<signs>"
    if token.isdigit():
        return "<digits>"
    if token.islower():
        return "<lower>"
    if token.istitle():
        return "<Title>"
    return "<UPPER>" if token.isupper() else "<miXed>"


def index_vectors(words: list[str]) -> np.ndarray:
    """The random index of each word: NONZERO places of +1 or -1, drawn from a hash of the word."""
    found = np.zeros((len(words), DIMENSIONS), np.int64)
    for row, word in enumerate(words):
        state = np.uint64(int.from_bytes(word.encode("utf-8", "surrogatepass")[:64].ljust(8, b"\0"), "little") % (2**64 - 59))
        draws = mix(np.arange(1, NONZERO + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(np.array([state]))[0])
        np.add.at(found[row], (draws % np.uint64(DIMENSIONS)).astype(np.int64), np.where(draws >> np.uint64(63), 1, -1))
    return found


class Lookup(dict):
    """The number of a token's word: its own, or its shape's. Tokens seen are kept, up to a bound."""

    KEEP = 200_000

    def __init__(self, words: list[str]) -> None:
        super().__init__((w, i) for i, w in enumerate(words))
        self.words = dict(self)

    def __missing__(self, token: str) -> int:
        if len(self) > self.KEEP:
            self.clear()
            self.update(self.words)
        number = self[token] = self.words[shape_of(token)]
        return number


def numbers_of(texts: pa.Array, lookup: Lookup) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers of all texts one after another, first places)."""
    again = lookup[AGAIN]
    every = (tokens_of(x.as_py() or "") for x in texts)
    rows = [[again if t == before else lookup[t] for t, before in zip(tokens, [None, *tokens])] for tokens in every]
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    return np.concatenate([np.array(r, np.int64) for r in rows]) if rows else np.zeros(0, np.int64), first


def add_contexts(sums: np.ndarray, numbers: np.ndarray, first: np.ndarray, indexes: np.ndarray) -> None:
    """Add to each word the indexes of its neighbours within WINDOW in the same text."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    size = len(indexes)
    for step in range(1, WINDOW + 1):
        same = owner[step:] == owner[:-step]
        pairs, times = np.unique(numbers[:-step][same] * size + numbers[step:][same], return_counts=True)
        for left, right in ((pairs // size, pairs % size), (pairs % size, pairs // size)):
            order = np.argsort(left, kind="stable")
            left, right, n = left[order], right[order], times[order]
            starts = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]])) if len(left) else np.zeros(0, np.int64)
            begin = 0
            while begin < len(starts):  # some 10,000 pairs' indexes at once, however long a text is
                stop = max(begin + 1, int(np.searchsorted(starts, starts[begin] + PAIRS)))
                part, low, high = starts[begin:stop], starts[begin], starts[stop] if stop < len(starts) else len(left)
                sums[left[part]] += np.add.reduceat(indexes[right[low:high]] * n[low:high, None], part - low, axis=0)
                begin = stop


class Model(NamedTuple):
    words: list[str]
    vectors: np.ndarray  # of each word, with its weight
    weights: np.ndarray  # of each word in a document
    background: np.ndarray  # the corpus's mean vector
    prior: float  # its weight in a document
    mean: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]  # first weights and bias, second weights and bias
    temperature: float

    def pooled(self, texts: pa.Array, lookup: Lookup) -> np.ndarray:
        """A row per text: the weighted mean of its words' vectors and the prior's, its length's logarithm and whether it has words."""
        numbers, first = numbers_of(texts, lookup)
        n = np.diff(first)
        out = np.zeros((len(texts), self.vectors.shape[1] + 2))
        out[:, :-2] = self.background
        for row in np.flatnonzero(n).tolist():
            words, times = np.unique(numbers[first[row] : first[row + 1]], return_counts=True)
            weight = times * self.weights[words]
            out[row, :-2] = (weight @ self.vectors[words] + self.prior * self.background) / (weight.sum() + self.prior)
        out[:, -2], out[:, -1] = np.log1p(n), n > 0
        return out

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        first, bias, second, last = self.layers
        return np.tanh((pooled - self.mean) / self.scale @ first + bias) @ second + last

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled) / self.temperature, -500, 500)))


def training_sample(docs: DataFrame, labels: DataFrame, learn: Column | None, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text, good) of about `rows` labelled documents, chosen by a hash of the id. Several labels of an id: the lowest."""
    label = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    label = label if learn is None else label.filter(learn)
    share = min(1.0, rows / max(label.count(), 1))
    chosen = label.filter(F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(1 << 20)) < share * (1 << 20))
    chosen = chosen.groupBy(F.col("doc_id").alias("id")).agg((F.min("quality") > 0).alias("good"))
    texts = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id")  # bounded by `rows`


def _vocabulary(sample: DataFrame, most: int) -> list[str]:
    """The shapes, the sign for a repeated token, and the words of the sample that are in LEAST_TEXTS of its texts or more, the most common `most` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            seen: Counter = Counter()
            for text in part.column("text"):
                seen.update({t for t in tokens_of(text.as_py()) if len(t) <= 32})
            yield pa.RecordBatch.from_pydict({"word": pa.array(seen.keys(), pa.string()), "n": pa.array(seen.values(), pa.int64())})

    counted = sample.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_TEXTS)
    return [*SHAPES, AGAIN, *(r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(most).collect())]


def word_vectors(docs: DataFrame, words: list[str], text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """(occurrences, vectors) of the given words over all whole texts.

    Each task adds up a table of the vocabulary's size; Spark adds the tasks' tables. All are whole numbers, so the
    result is the same on any layout.
    """
    sent = docs.sparkSession.sparkContext.broadcast(words)  # bounded by VOCABULARY
    names = [f"v{k}" for k in range(DIMENSIONS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, indexes = Lookup(sent.value), index_vectors(sent.value)
        sums, counts = np.zeros_like(indexes), np.zeros(len(indexes), np.int64)
        for part in slices(batches):
            numbers, first = numbers_of(part.column("text"), lookup)
            counts += np.bincount(numbers, minlength=len(counts))
            add_contexts(sums, numbers, first, indexes)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some]), *(pa.array(sums[some, k]) for k in range(DIMENSIONS))], names=["word", "n", *names])

    tables = docs.select(docs[text_col].alias("text")).mapInArrow(run, "word bigint, n bigint, " + ", ".join(f"{c} bigint" for c in names))
    total = tables.groupBy("word").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in names)).toPandas()
    counts, sums = np.zeros(len(words)), np.zeros((len(words), DIMENSIONS))
    at = total["word"].to_numpy(np.int64)
    counts[at], sums[at] = total["n"].to_numpy(float), total[names].to_numpy(float)
    unit = lambda v: v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    return counts, np.hstack([unit(sums), OWN * unit(index_vectors(words).astype(float))])


def _train(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """Weights of the two layers, by Adam over the whole sample; the same for the same rows."""
    draw = np.random.default_rng(12)
    layers = [draw.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second = ([np.zeros_like(w) for w in layers] for _ in range(2))
    for step in range(1, STEPS + 1):
        hidden = np.tanh(x @ layers[0] + layers[1])
        error = (1 / (1 + np.exp(-(hidden @ layers[2] + layers[3]))) - y) / len(y)
        back = error[:, None] * layers[2] * (1 - hidden**2)
        slopes = [x.T @ back + DECAY * layers[0], back.sum(0), hidden.T @ error + DECAY * layers[2], error.sum(keepdims=True)]
        for k, slope in enumerate(slopes):
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            layers[k] = layers[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits under which rows not trained on are likeliest."""
    loss = lambda t: float(np.logaddexp(0, -np.where(y > 0, 1, -1) * logits / t).mean())
    return min(np.geomspace(0.25, 10, 80).tolist(), key=loss) if len(y) else 1.0


def learn_model(docs: DataFrame, sample: DataFrame, text_col: str = "text", vocabulary: int = VOCABULARY) -> Model:
    """Word vectors counted over all documents; weights and temperature from the labelled sample.

    What comes to the driver is bounded: the vocabulary's vectors, and one pooled vector for each sampled text.
    Without labels, or with one label only, all texts get the label's share (half without any).
    """
    workers_see_library(docs.sparkSession)
    sample = materialize(sample, "quality-sample")
    words = _vocabulary(sample, vocabulary)
    counts, vectors = word_vectors(docs, words, text_col)
    weights = SMOOTH / (SMOOTH + counts / max(counts.sum(), 1))
    share = counts * weights / max((counts * weights).sum(), 1e-9)
    prior = PRIOR * float((counts * weights).sum() / max(counts.sum(), 1)) if counts.sum() else 1.0
    width = vectors.shape[1] + 2
    model = Model(words, vectors, weights, share @ vectors, prior, np.zeros(width), np.ones(width), (np.zeros((width, 1)), np.zeros(1), np.zeros(1), np.zeros(1)), 1.0)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(sent.value.words)
        for part in slices(batches):
            pooled = sent.value.pooled(part.column("text"), lookup)
            yield pa.RecordBatch.from_arrays([part.column("good"), part.column("fit"), pa.array(list(pooled), pa.list_(pa.float64()))], names=["good", "fit", "pooled"])

    fit = F.pmod(F.xxhash64("id", F.lit(21)), F.lit(CALIBRATE)) != 0
    rows = sample.select("text", "good", fit.alias("fit")).mapInArrow(run, "good boolean, fit boolean, pooled array<double>").toPandas()
    y = rows["good"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return model._replace(layers=(*model.layers[:3], np.array([np.log(share / (1 - share))])))
    x, train = np.stack(rows["pooled"]), rows["fit"].to_numpy(bool)
    order = np.lexsort([*x.T, y])  # the order in which rows arrive says nothing
    x, y, train = x[order], y[order], train[order]
    if len(np.unique(y[train])) < 2 or len(np.unique(y[~train])) < 2:
        train = np.ones(len(y), bool)
    mean, scale = x[train].mean(0), x[train].std(0) + 1e-6
    model = model._replace(mean=mean, scale=scale, layers=_train((x[train] - mean) / scale, y[train]))
    return model._replace(temperature=_temperature(model.logits(x[~train]), y[~train]))


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score (0 to 1, higher: better) and predicted (1 from `threshold` on) of every whole text.

    Null and empty texts, and texts without words, are scored by the corpus's mean vector. Repeated rows are scored each;
    null ids stay null; other columns are ignored. No shuffle; memory is one slice of texts, or one text.
    """
    spark = docs.sparkSession
    workers_see_library(spark)
    sent = spark.sparkContext.broadcast(model)  # bounded by VOCABULARY

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(sent.value.words)
        for part in slices(batches):
            scores = sent.value.scores(sent.value.pooled(part.column("text"), lookup))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=["id", "score", "predicted"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(run, f"id {id_type}, score double, predicted int")
    return rows.withColumnRenamed("id", id_col)
