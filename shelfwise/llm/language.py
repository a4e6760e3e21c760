"""Operator 9, language identification: interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import STEPS, mix, slices, workers_see_library

ORDER = 4  # characters of the longest n-gram, the predicted one included
DISCOUNT = 0.75
PER_LANGUAGE = 1000  # expected rows of each language in the training sample
UNKNOWN = "und"
REJECT_SHARE = 0.005  # share of training texts that the rejection limit would turn away

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, first places, numbers of letters): lower case, each run of other signs one space, ORDER - 1 spaces ahead."""
    lead = "\n" * (ORDER - 1)
    lowered = [lead + t.lower() for t in texts]
    raw = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate([[0], np.cumsum([len(t) for t in lowered])]).astype(np.int64)
    letter = _is_letter()[raw]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[(at[:-1, None] + np.arange(ORDER - 1)).ravel()] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(letter)])
    return np.where(letter, raw, 32)[keep].astype(np.uint64), kept[at], np.diff(letters[at])


def suffix_hashes(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of the last 1, 2, ... characters, given the characters from the last one backwards."""
    total, found = np.zeros(len(columns[0]), np.uint64), []
    for k, c in enumerate(columns):
        total = total + c * STEPS[k]
        found.append(mix(total + np.uint64(k + 1)))
    return found


class Model(NamedTuple):
    """Log-probabilities of known n-grams by order, and weights of contexts, a column per language."""

    languages: list[str]
    grams: list[np.ndarray]  # by order from 1: sorted hashes
    chances: list[np.ndarray]
    contexts: list[np.ndarray]  # by length from 0: sorted hashes of contexts
    weights: list[np.ndarray]
    floor: float  # log-probability of a character that no language has
    sharpness: float
    limit: float  # mean log-probability below which a text is of no known language


def _find(ordered: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(ordered):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return at, ordered[at] == values


def fit(counts: pd.DataFrame) -> Model:
    """Models from n-gram counts (lang, gram, n): `gram` has ORDER characters, the predicted one last."""
    languages = sorted(counts["lang"].unique())
    codes = np.array([[ord(c) for c in g] for g in counts["gram"]], np.uint64).reshape(-1, ORDER)
    n_signs = len(np.unique(codes)) + 1
    floor = -np.log(n_signs)
    per_language = []
    for lang in languages:
        own = (counts["lang"] == lang).to_numpy()
        grams, n = codes[own], counts["n"].to_numpy()[own].astype(float)
        tables = [None] * (ORDER + 1)
        for k in range(ORDER, 0, -1):
            back = [grams[:, j] for j in range(grams.shape[1] - 1, -1, -1)]
            hashes = suffix_hashes(back)[-1]
            context = suffix_hashes(back[1:])[-1] if k > 1 else np.zeros(len(grams), np.uint64)
            order = np.argsort(hashes)
            seen, inverse = np.unique(context, return_inverse=True)
            tables[k] = (hashes[order], n[order], seen, np.bincount(inverse, n), np.bincount(inverse).astype(float))
            shorter, first, group = np.unique(suffix_hashes(back)[-2] if k > 1 else hashes, return_index=True, return_inverse=True)
            grams, n = grams[first][:, 1:], np.bincount(group).astype(float)  # how many signs the shorter one follows
        per_language.append(tables)

    def chance(tables: list, back: list[np.ndarray]) -> np.ndarray:
        k = len(back)
        lower = chance(tables, back[:-1]) if k > 1 else np.full(len(back[0]), np.exp(floor))
        hashes, n, contexts, totals, kinds = tables[k]
        at, known = _find(hashes, suffix_hashes(back)[-1])
        count = np.where(known, n[at], 0.0)
        where, seen = _find(contexts, suffix_hashes(back[1:])[-1] if k > 1 else np.zeros(len(back[0]), np.uint64))
        p = (np.maximum(count - DISCOUNT, 0) + DISCOUNT * kinds[where] * lower) / totals[where]
        return np.where(seen, p, lower)

    grams, chances, contexts, weights = [], [], [], []
    for k in range(1, ORDER + 1):
        every = np.unique(codes[:, ORDER - k :], axis=0)
        back = [every[:, j] for j in range(k - 1, -1, -1)]
        hashes = suffix_hashes(back)[-1]
        order = np.argsort(hashes)
        grams.append(hashes[order])
        chances.append(np.stack([np.log(chance(t, back))[order] for t in per_language], 1).astype(np.float32))
        union = np.unique(np.concatenate([t[k][2] for t in per_language]))
        weight = np.zeros((len(union), len(languages)), np.float32)
        for column, t in enumerate(per_language):
            at, seen = _find(t[k][2], union)
            weight[:, column] = np.where(seen, np.log(DISCOUNT * t[k][4][at] / t[k][3][at]), 0.0)
        contexts.append(union)
        weights.append(weight)
    return Model(languages, grams, chances, contexts, weights, floor, 1.0, -np.inf)


def mean_chances(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean log-probability per sign, a row per text and a column per language; signs; letters)."""
    codes, first, letters = characters(texts)
    n = len(codes)
    back = [np.concatenate([np.zeros(j, np.uint64), codes[: n - j]]) for j in range(ORDER)]
    hashes = suffix_hashes(back)
    at, known = _find(model.grams[-1], hashes[-1])
    logs = model.chances[-1][at]
    missing = np.flatnonzero(~known)
    total = np.zeros((len(missing), len(model.languages)), np.float32)
    todo = np.arange(len(missing))
    for k in range(ORDER - 1, -1, -1):  # weight of the context of k characters, then the n-gram of k characters
        place = missing[todo]
        context = hashes[k - 1][place - 1] if k else np.zeros(len(place), np.uint64)
        where, seen = _find(model.contexts[k], context)
        total[todo] += np.where(seen[:, None], model.weights[k][where], 0)
        if not k:
            total[todo] += model.floor
            break
        where, seen = _find(model.grams[k - 1], hashes[k - 1][place])
        total[todo[seen]] += model.chances[k - 1][where[seen]]
        todo = todo[~seen]
    logs[missing] = total
    sums = np.concatenate([np.zeros((1, logs.shape[1])), np.cumsum(logs, 0, dtype=np.float64)])
    start = first[:-1] + ORDER - 1
    signs = first[1:] - start
    return (sums[first[1:]] - sums[start]) / np.maximum(signs, 1)[:, None], signs, letters


def confidences(model: Model, means: np.ndarray, signs: np.ndarray) -> np.ndarray:
    scaled = means * (model.sharpness * np.sqrt(np.maximum(signs, 1)))[:, None]
    e = np.exp(scaled - scaled.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def training_sample(docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """Whole texts of about `per_language` rows of each language, chosen by a hash of the id: the same rows on any layout."""
    rows = docs.filter(learn & docs[lang_col].isNotNull() & docs[text_col].isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(docs[lang_col]).count().collect()}
    share = F.lit(1.0)
    for lang, n in sizes.items():
        share = F.when(docs[lang_col] == lang, F.lit(min(1.0, per_language / n))).otherwise(share)
    return rows.filter(F.pmod(F.xxhash64(docs[id_col], F.lit(9)), F.lit(1 << 20)) < share * (1 << 20)).select(docs[lang_col].alias("lang"), docs[text_col].alias("text"))


def learn_model(sample: DataFrame) -> Model | None:
    """Models of the sample's languages, with calibrated confidence and rejection; None for an empty sample.

    N-grams are counted in Spark. Their number is bounded by the sample, not by the corpus, so the counts may come to
    the driver and the model may be sent to the workers.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            langs = np.array(part.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                texts = [t for t, own in zip(part.column("text").to_pylist(), langs == lang) if own]
                codes, first, _ = characters(texts)
                ends = np.ones(len(codes), bool)
                ends[(first[:-1, None] + np.arange(ORDER - 1)).ravel()] = False
                ends = np.flatnonzero(ends)
                if len(ends):
                    back = [codes[ends - j] for j in range(ORDER)]
                    _, at, n = np.unique(suffix_hashes(back)[-1], return_index=True, return_counts=True)
                    names = ["".join(map(chr, g)) for g in np.stack([c[at] for c in back[::-1]], 1).tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names)), pa.array(names, pa.string()), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    counts = sample.mapInArrow(count, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    if counts.empty:
        return None
    model = fit(counts.sort_values(["lang", "gram"]).reset_index(drop=True))
    sent = sample.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            means, signs, letters = mean_chances(sent.value, part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), pa.array(list(means), pa.list_(pa.float64())), pa.array(signs), pa.array(letters)], names=["lang", "means", "signs", "letters"]
            )

    scored = sample.mapInArrow(score, "lang string, means array<double>, signs bigint, letters bigint").filter("letters > 0").toPandas()
    if scored.empty:
        return model
    means, signs = np.stack(scored["means"]), scored["signs"].to_numpy()
    truth = np.array([model.languages.index(x) for x in scored["lang"]])
    best = (np.inf, 1.0)
    for sharpness in np.geomspace(0.1, 30, 40):
        p = confidences(model._replace(sharpness=sharpness), means, signs)[np.arange(len(truth)), truth]
        best = min(best, (float(-np.log(np.clip(p, 1e-6, 1)).mean()), float(sharpness)))
    return model._replace(sharpness=best[1], limit=float(np.quantile(means.max(1), REJECT_SHARE)))


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score, cross_entropy (nats per sign) and rejected, for every whole text.

    The language of the lowest length-normalised cross-entropy; `score` is its calibrated share. Null texts and texts
    without a letter are `und` with score 0, and so is everything if there is no model. `rejected` marks texts that fit
    no learnt language; their best language is still named. Repeated rows are judged each; null ids stay null; other
    columns are ignored. No shuffle; memory is bounded by a slice of texts, or one text.
    """
    spark = docs.sparkSession
    workers_see_library(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = f"`{id_col}` {id_type}, lang_pred string, score double, cross_entropy double, rejected boolean"
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for part in slices(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            if model is None:
                lang, score, entropy, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts), [True] * len(texts)
            else:
                means, signs, letters = mean_chances(model, texts)
                best, some = means.argmax(1), letters > 0
                share = confidences(model, means, signs)[np.arange(len(texts)), best]
                top = means[np.arange(len(texts)), best]
                lang = [model.languages[b] if s else UNKNOWN for b, s in zip(best, some)]
                score, entropy = np.where(some, share, 0.0), [float(-x) if s else None for x, s in zip(top, some)]
                rejected = ~some | (top < model.limit)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(entropy, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[id_col, "lang_pred", "score", "cross_entropy", "rejected"],
            )

    return rows.mapInArrow(run, schema)


def learn_and_identify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """Learn from the rows where `learn` holds, then judge every row."""
    workers_see_library(docs.sparkSession)
    return identify(docs, learn_model(training_sample(docs, learn, id_col, text_col, lang_col, per_language)), id_col, text_col)
