"""Operator 4, toxicity: Levenshtein automata over a learnt lexicon's trie, and windows that tell quoting from abuse."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import slices, workers_see_library
from shelfwise.llm.tokens import Memory
from shelfwise.session import materialize

SAMPLE = 12_000  # expected labelled rows to learn from
WINDOW = 8  # words on either side of a hit
STEM = range(3, 9)  # lengths of learnt stems
ONE_EDIT_FROM, TWO_EDITS_FROM = 4, 8  # terms of so many signs also match at one edit, at two
SURE = 6.0  # weight of a plain hit of a term that is hardly ever seen elsewhere
LEAST_WEIGHT = 0.5  # what a hit at some distance must say for the term to match at it
SHARE = 0.5  # toxic share that texts with a term need
EVIDENCE = 13.0  # log-likelihood ratio that a term needs: chance alone reaches it once in 400,000 terms
QUOTED = 0.7  # window score from which a hit is a quotation

# Words that report what others say, and words that address the reader.
REPORTING = frozenset("said says called wrote quoted quote reported claimed term word dit disait écrit appelé mot sagte sagt schrieb nannte wort dijo dice escribió llamó palabra".split())
ADDRESS = frozenset("you your yours yourself tu te toi vous votre du dich dir dein ihr euch usted ustedes tú ti vosotros".split())
# Quotation marks.
OPENING, CLOSING = "\"“„«‹", "\"”“»›"

_WORD = re.compile(r"[^\W_]+")


class Term(NamedTuple):
    text: str
    stem: bool  # matches words that begin with it
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)  # of a plain hit, at one edit, at two
    fitted: bool = False

    @property
    def edits(self) -> int:
        """The most edits at which the term matches: by its length, a stem at one at most, and where the labelled texts allow it."""
        most = int(len(self.text) >= ONE_EDIT_FROM) + int(len(self.text) >= TWO_EDITS_FROM and not self.stem)
        return max([0, *(e for e in range(1, most + 1) if self.weights[e] >= LEAST_WEIGHT)]) if self.fitted else most


class LexiconAutomaton:
    """The union of the terms' Levenshtein automata, walked through the trie of the terms.

    An edit inserts, leaves out or replaces a sign, or swaps two neighbours. A state is a set of (trie node, edits so
    far, sign that a swap still owes). States and moves are made when a word first needs them, and most words reach the
    empty state after a few signs.
    """

    KEEP_STATES = 50_000

    def __init__(self, terms: list[Term]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.allowed = [0]  # most edits of any term below
        for number, term in enumerate(terms):
            node = 0
            self.allowed[0] = max(self.allowed[0], term.edits)
            for sign in term.text:
                if sign not in self.children[node]:
                    self.children[node][sign] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.allowed.append(0)
                node = self.children[node][sign]
                self.allowed[node] = max(self.allowed[node], term.edits)
            self.ends[node].append(number)
        self._restart()
        self.hits = Memory(self.match)

    def _restart(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []
        self.members: list[frozenset] = []
        self.finals: list[tuple] = []  # (whole-word hits, stem hits) as {term: edits}
        self._state({(0, 0, "")})

    def _state(self, members: set) -> int:
        todo = [m for m in members if not m[2]]
        while todo:  # a sign of the term that the word leaves out
            node, edits, _ = todo.pop()
            for child in self.children[node].values():
                if edits + 1 <= self.allowed[child] and (child, edits + 1, "") not in members:
                    members.add((child, edits + 1, ""))
                    todo.append((child, edits + 1, ""))
        least: dict[tuple[int, str], int] = {}
        for node, edits, owed in members:
            least[node, owed] = min(edits, least.get((node, owed), edits))
        key = frozenset((node, edits, owed) for (node, owed), edits in least.items())
        if key not in self.states:
            self.states[key] = len(self.moves)
            self.moves.append({})
            self.members.append(key)
            words, stems = {}, {}
            for node, edits, owed in key:
                for number in self.ends[node] if not owed else ():
                    if edits <= self.terms[number].edits:
                        into = stems if self.terms[number].stem else words
                        into[number] = min(edits, into.get(number, edits))
            self.finals.append((words, stems))
        return self.states[key]

    def _move(self, state: int, sign: str) -> int:
        after = set()
        for node, edits, owed in self.members[state]:
            if owed:
                if owed == sign:
                    after.add((node, edits, ""))
                continue
            for other, child in self.children[node].items():
                cost = edits + (other != sign)
                if cost <= self.allowed[child]:
                    after.add((child, cost, ""))
                if other != sign:
                    beyond = self.children[child].get(sign)  # the word has the next two signs swapped
                    if beyond is not None and cost <= self.allowed[beyond]:
                        after.add((beyond, cost, other))
            if edits + 1 <= self.allowed[node]:
                after.add((node, edits + 1, ""))
        found = self.moves[state][sign] = self._state(after) if after else -1
        return found

    def match(self, word: str) -> tuple[tuple[int, int], ...]:
        """(term, edits) of the terms that the word is, or begins with, within their edits."""
        if len(self.moves) > self.KEEP_STATES:
            self._restart()
        state, found = 0, {}
        for sign in word:
            state = self.moves[state].get(sign) if sign in self.moves[state] else self._move(state, sign)
            if state < 0:
                break
            for number, edits in self.finals[state][1].items():
                found[number] = min(edits, found.get(number, edits))
        if state >= 0:
            for number, edits in self.finals[state][0].items():
                found[number] = min(edits, found.get(number, edits))
        return tuple(sorted(found.items()))


WINDOW_PRIOR = (1.0, 0.7, -0.7)  # of marks around a hit, a reporting word, direct address; where fitting starts from


def window_features(text: str, spans: list[tuple[int, int]], words: list[str], at: int) -> int:
    """What stands around a hit, as bits: 1 quotation marks, 2 a reporting word, 4 direct address."""
    low, high = max(0, at - WINDOW), min(len(words), at + WINDOW + 1)
    before, after = text[spans[low][0] : spans[at][0]], text[spans[at][1] : spans[high - 1][1] + 2]
    opened = max(before.rfind(c) for c in OPENING)
    marked = opened >= 0 and not any(c in before[opened + 1 :] for c in CLOSING) and any(c in after for c in CLOSING)
    around = [*words[low:at], *words[at + 1 : high]]
    return marked + 2 * any(w in REPORTING for w in around) + 4 * any(w in ADDRESS for w in around)


def find_hits(automaton: LexiconAutomaton, text: str) -> tuple[dict[tuple[int, int, int], int], int]:
    """({(term, edits, window): hits}, words if there is a hit) of a whole text. Words of letters and digits, in lower case."""
    text = text.lower()
    hits = automaton.hits
    toxic = {w for w in set(_WORD.findall(text)) if hits[w]}
    if not toxic:
        return {}, 0
    spans = [m.span() for m in _WORD.finditer(text)]
    words = [text[a:b] for a, b in spans]
    found: Counter = Counter()
    for at, word in enumerate(words):
        if word in toxic:
            window = window_features(text, spans, words, at)
            for number, edits in hits[word]:
                found[number, edits, window] += 1
    return found, len(words)


class ToxicityModel(NamedTuple):
    terms: list[Term]
    beta: tuple[float, ...]  # of the features
    window: tuple[float, ...] = WINDOW_PRIOR  # how much each sign of a window speaks for a quotation

    def quoted(self, window: int) -> bool:
        return sum(w for k, w in enumerate(self.window) if window >> k & 1) >= QUOTED

    def features(self, found: dict, n_words: int) -> list[float]:
        """1; weights of the distinct terms hit in abuse; those only quoted (each held to 8); logs of the weighted hits
        and of the length, as one chance hit in a long text says little."""
        if not found:
            return [1.0, 0.0, 0.0, 0.0, 0.0]
        best: dict[int, list[float]] = {}
        hits = 0.0
        for (number, edits, window), times in found.items():
            own, quoted, weight = best.setdefault(number, [0.0, 0.0]), self.quoted(window), self.terms[number].weights[edits]
            own[quoted] = max(own[quoted], weight)
            hits += times * weight * (not quoted)
        plain = sum(p for p, _ in best.values())
        quotation = sum(q for p, q in best.values() if not p)
        return [1.0, min(plain, 8.0), min(quotation, 8.0), float(np.log1p(hits)), float(np.log1p(n_words)) * (hits > 0)]

    def score(self, found: dict, n_words: int) -> float:
        return float(1 / (1 + np.exp(-np.dot(self.features(found, n_words), self.beta))))


def fit_logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, centre: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    """Weights of a logistic model, each drawn to its centre by its ridge; by Newton steps that never raise the loss."""
    beta = centre.copy()

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(weights @ (np.logaddexp(0, z) - y * z) + 0.5 * ridge @ (b - centre) ** 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ beta))
        step = np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (weights * (y - p)) - ridge * (beta - centre))
        size = 1.0
        while size > 1e-6 and loss(beta + size * step) > loss(beta):
            size /= 2
        beta = beta + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return beta


def fit_window(every: list[tuple[dict, int, int]], terms: list[Term]) -> tuple[float, ...]:
    """Weights of the window's signs, from texts whose plain hits all stand in like windows: what makes a hit less toxic is quoting.

    A text's strongest hits decide; few quotations in the sample leave the weights near where they start.
    """
    x, y = [], []
    for found, _, toxic in every:
        windows = {w for (k, edits, w) in found if terms[k].weights[edits] > 1.0}
        if len(windows) == 1:
            window = windows.pop()
            x.append([1.0, *(float(window >> k & 1) for k in range(3))])
            y.append(float(toxic))
    centre = np.array([2.0, *(-w for w in WINDOW_PRIOR)])
    if not x:
        return WINDOW_PRIOR
    beta = fit_logistic(np.array(x), np.array(y), np.ones(len(y)), centre, np.array([0.1, 8.0, 8.0, 8.0]))
    return tuple(float(-b) for b in beta[1:])


def training_sample(docs: DataFrame, labels: DataFrame, learn: Column | None, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(text, toxic) of about `rows` labelled documents, chosen by a hash of the id. Several labels of an id: the highest."""
    label = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    label = label if learn is None else label.filter(learn)
    total = label.count()
    share = min(1.0, rows / max(total, 1))
    chosen = label.filter(F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1 << 20)) < share * (1 << 20))
    chosen = chosen.groupBy(F.col("doc_id").alias("id")).agg((F.max("toxic") > 0).alias("toxic"))
    texts = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("text", "toxic")  # bounded by `rows`


def evident(counts: pd.DataFrame, base: float) -> pd.DataFrame:
    """The rows (term, pos, neg) whose log-likelihood ratio against the base rate is enough, with it."""
    pos, neg = counts["pos"].to_numpy(float), counts["neg"].to_numpy(float)
    share = pos / np.maximum(pos + neg, 1)
    ratio = pos * np.log(np.maximum(share, 1e-9) / base) + neg * np.log(np.maximum(1 - share, 1e-9) / (1 - base))
    return counts.assign(ratio=ratio.round(6))[(ratio >= EVIDENCE) & (share >= SHARE)]


def choose_terms(counts: pd.DataFrame, base: float) -> list[Term]:
    """Terms from (term, pos, neg), by their evidence, none a stem of another; a stem is written with a star.

    Of equally good ones the longest wins, and a whole word over its stem: what is learnt should say no more than seen.
    """
    counts = evident(counts, base)
    counts = counts.assign(size=counts["term"].str.rstrip("*").str.len(), stem=counts["term"].str.endswith("*"))
    counts = counts.sort_values(["ratio", "size", "stem", "term"], ascending=[False, False, True, True])
    stems: set[str] = set()
    taken: list[Term] = []
    covered: set[str] = set()
    for term, stem in zip(counts["term"], counts["stem"]):
        text = term.rstrip("*")
        if any(text[:k] in stems for k in range(1, len(text) + 1)) or text in covered:
            continue
        taken.append(Term(text, bool(stem)))
        if stem:
            stems.add(text)
        covered.update(text[:k] for k in range(1, len(text) + 1))
    return taken


def learn_model(sample: DataFrame) -> ToxicityModel:
    """Lexicon, weights and calibration from (text, toxic). Without toxic texts: no terms, and a low score for all.

    Term counts are made in Spark; what comes to the driver is bounded by the sample: terms in enough toxic texts, and
    the distinct hits of each sampled text.
    """
    workers_see_library(sample.sparkSession)
    sample = materialize(sample, "toxicity-sample")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_pos, n_neg = sizes.get(True, 0), sizes.get(False, 0)
    if not n_pos or not n_neg:
        return ToxicityModel([], (-4.0 if not n_pos else 0.0, 0.0, 0.0, 0.0, 0.0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            seen = (Counter(), Counter())
            for text, toxic in zip(part.column("text"), part.column("toxic")):
                words = set(_WORD.findall(text.as_py().lower()))
                stems = {w[:k] + "*" for w in words for k in STEM if len(w) >= k}
                seen[toxic.as_py()].update(w for w in words if len(w) > 2)
                seen[toxic.as_py()].update(stems)
            terms = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in (seen[1], seen[0]))], names=["term", "pos", "neg"]
            )

    counts = sample.mapInArrow(count, "term string, pos bigint, neg bigint").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    base = n_pos / (n_pos + n_neg)
    enough = (F.col("pos") >= SHARE * (F.col("pos") + F.col("neg"))) & (F.col("pos") * F.lit(-np.log(base)) >= EVIDENCE)
    likely = frozenset(counts.filter(enough).toPandas().pipe(evident, base)["term"])

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows: dict[tuple, None] = {}
            for text, toxic in zip(part.column("text"), part.column("toxic")):
                words = _WORD.findall(text.as_py().lower())
                digest = hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()
                every = {term for w in set(words) for term in (w, *(w[:k] + "*" for k in STEM if len(w) >= k)) if term in likely}
                rows.update(dict.fromkeys((term, toxic.as_py(), digest) for term in every))
            term, toxic, digest = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(term, pa.string()), pa.array(toxic, pa.bool_()), pa.array(digest, pa.binary())], names=["term", "toxic", "digest"])

    # copies of one text (the same words in the same order) say a thing once; all other texts count
    apart = sample.mapInArrow(held, "term string, toxic boolean, digest binary").distinct().groupBy("term")
    terms = choose_terms(apart.agg(F.count_if("toxic").alias("pos"), F.count_if(~F.col("toxic")).alias("neg")).toPandas(), base)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = LexiconAutomaton(terms)
        for part in slices(batches):
            rows = [find_hits(automaton, x.as_py()) for x in part.column("text")]
            found = [[[k, e, w, n] for (k, e, w), n in f.items()] for f, _ in rows]
            sizes = pa.array([n for _, n in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(found, pa.list_(pa.list_(pa.int64()))), sizes], names=["toxic", "found", "words"])

    table = sample.mapInArrow(hits, "toxic boolean, found array<array<bigint>>, words bigint").filter(F.size("found") > 0).toPandas()
    evidence = np.zeros((len(terms), 3, 2))  # term, edits, toxic
    every = [({(int(k), int(e), int(w)): int(n) for k, e, w, n in found}, int(words), int(toxic)) for toxic, found, words in zip(table["toxic"], table["found"], table["words"])]
    every.sort(key=lambda row: (sorted(row[0].items()), *row[1:]))  # the order in which rows arrive says nothing
    for found, _, toxic in every:
        for k, e in {(k, e) for k, e, _ in found}:
            evidence[k, e, toxic] += 1
    odds = n_pos / n_neg
    terms = [t._replace(weights=w, fitted=True) for t, w in zip(terms, distance_weights(terms, evidence, odds))]
    every = [({hit: n for hit, n in found.items() if hit[1] <= terms[hit[0]].edits}, words, toxic) for found, words, toxic in every]
    every = [row for row in every if row[0]]
    model = ToxicityModel(terms, (), fit_window(every, terms))
    none = model.features({}, 0)
    x = np.array([*(model.features(found, words) for found, words, _ in every), none, none])  # texts without a hit by their number
    y = np.array([*(toxic for _, _, toxic in every), 0, 1], float)
    weights = np.ones(len(y))
    weights[-2:] = n_neg - (y[:-2] == 0).sum(), n_pos - y[:-2].sum()
    centre = np.array([np.log(odds), 1.0, 0.4, 0.0, 0.0])
    beta = fit_logistic(x, y, weights, centre, np.array([0.1, 2.0, 8.0, 1.0, 1.0]))  # few quotations: their weight stays near the prior
    return model._replace(beta=tuple(float(b) for b in beta))


def distance_weights(terms: list[Term], evidence: np.ndarray, odds: float) -> list[tuple[float, ...]]:
    """The log-odds that a hit of each term at 0, 1 and 2 edits says, held to 0 to 8.

    Plain hits by their own texts. Misspelt ones are rarer, so they are drawn to all terms' share at that distance, words
    and stems, the shortest of them and the surest, among themselves: where their neighbours turn out to be common words, they weigh nothing.
    """
    plain = np.log((evidence[:, 0, 1] + 0.5) / (evidence[:, 0, 0] + 0.5) / odds)
    kind = np.array([4 * (p >= SURE) + 2 * (len(t.text) == ONE_EDIT_FROM) + t.stem for p, t in zip(plain, terms)], int)
    found = []
    for i, term in enumerate(terms):
        weights = [plain[i]]
        for edits in (1, 2):
            neg, pos = evidence[kind == kind[i], edits].T
            share = ((pos + 0.6) / (pos + neg + 1.0)).mean()  # each term once: one with common neighbours does not speak for all
            own_neg, own_pos = evidence[i, edits]
            weights.append(np.log((own_pos + 2 * share) / (own_neg + 2 * (1 - share)) / odds) if edits <= term.edits else 0.0)
        found.append(tuple(float(np.clip(w, 0.0, 8.0)) for w in weights))
    return found


def score_documents(docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: list[str] | None = None, threshold: float = 0.7) -> DataFrame:
    """The columns in `keep`, then score, predicted and hits (term, edits, quoted, times) of every whole text.

    Null and empty texts have no hits and the score of such texts. Repeated rows are scored each; null ids stay null;
    other columns are ignored. No shuffle; memory is one slice of texts, or one text.
    """
    spark = docs.sparkSession
    workers_see_library(spark)
    keep = ["doc_id"] if keep is None else keep
    sent = spark.sparkContext.broadcast(model)  # bounded by the training sample
    hit = pa.list_(pa.struct([("term", pa.string()), ("edits", pa.int32()), ("quoted", pa.bool_()), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        automaton = LexiconAutomaton(model.terms)
        for part in slices(batches):
            found = [find_hits(automaton, t.as_py() or "") for t in part.column("text")]
            scores = np.array([model.score(f, n) for f, n in found], float)
            named = []
            for f, _ in found:
                times: Counter = Counter()
                for (k, e, w), n in f.items():
                    times[model.terms[k].text, e, model.quoted(w)] += n
                named.append([{"term": t, "edits": e, "quoted": q, "times": n} for (t, e, q), n in sorted(times.items())])
            kept = [part.column(f"k{i}") for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), pa.array(named, hit)],
                names=[*(f"k{i}" for i in range(len(keep))), "score", "predicted", "hits"],
            )

    rows = docs.select(*(docs[c].alias(f"k{i}") for i, c in enumerate(keep)), docs[text_col].alias("text"))
    kinds = "".join(f"k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    scored = rows.mapInArrow(run, kinds + "score double, predicted int, hits array<struct<term:string,edits:int,quoted:boolean,times:bigint>>")
    return scored.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "score", "predicted", "hits")


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The documents that are not predicted toxic, with their columns."""
    names = [f"__{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index(text_col)]
    scored = score_documents(docs.toDF(*names), model, text, keep=names, threshold=threshold)
    return scored.filter("predicted = 0").select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
