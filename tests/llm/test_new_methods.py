"""Operators 11 to 13 against brute-force versions, held-out rows and odd input."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import classifier, common, negatives, queries, spelling

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute_variants(docs, slip=199, least_chars=6, least_count=5, ratio=5):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_count}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= ratio * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words}


def found_variants(frame):
    rows = frame.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_variants_of_the_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in common.table(spark, SF, "documents").collect()]
    assert found_variants(queries.op11_spelling_variants(spark, SF)) == brute_variants(docs)


def test_variants_of_close_words(spark):
    """Many words around few centres: insertions, deletions, replacements, permutations, chains of forms, accents, long runs."""
    draw = random.Random(11)
    texts = []
    for centre, times in (("banana", 700), ("stressed", 650), ("mississippi", 600), ("Éléphantó", 120), ("aaaaaaa", 90)):
        texts += [centre] * times
        for _ in range(250):
            word, signs = list(centre), centre + "z"
            for _ in range(draw.randint(1, 3)):
                at = draw.randrange(len(word) + 1)
                kind = draw.randrange(4)
                if kind == 0:
                    word.insert(at, draw.choice(signs))
                elif kind == 1 and word:
                    del word[at - 1]
                elif kind == 2 and word:
                    word[at - 1] = draw.choice(signs)
                else:
                    draw.shuffle(word)
            texts += ["".join(word)] * draw.choice([1, 4, 5, 6, 25, 26, 140])
    texts += ["x" * 3000, "x" * 2999 + "y"] * 5 + ["x" * 3001] * 30
    draw.shuffle(texts)
    docs = [(i % 97, " ".join(texts[i::150])) for i in range(150)] + [(None, "Banana banana"), (3, None), (4, ""), (3, "12 -- ."), (5, "banan×"), (5, "banan×")]
    frame = spark.createDataFrame([(i, t, "w", 1) for i, t in docs], "doc_id bigint, text string, word string, n int").repartition(7)
    expected = brute_variants(docs)
    assert found_variants(spelling.group_variants(frame)) == expected
    assert max(v[3] for v in expected.values()) > 10 and sum(v[1] != w for w, v in expected.items()) > 50
    chains = [w for w, v in expected.items() if v[0] and expected[v[0]][0]]
    assert chains
    assert spelling.group_variants(frame.limit(0)).count() == 0
    assert spelling.group_variants(frame.filter("text = ''")).count() == 0


def test_no_word_pair_outside_the_join(spark):
    """Thousands of permutations of one multiset share every multiset signature; the join emits none of their pairs."""
    draw = random.Random(5)
    words = set()
    while len(words) < 3000:
        letters = list("abcdefghijkl")
        draw.shuffle(letters)
        words.add("".join(letters))
    frame = spark.createDataFrame([(w, 5) for w in words], "word string, n bigint")
    pairs = {(r["a"], r["b"]) for r in spelling.near_words(frame).collect()}
    assert pairs == {(a, b) for a in words for k in range(12) for c in "abcdefghijkl" if (b := a[:k] + c + a[k + 1 :]) in words and a != b}


def brute_negatives(rows, is_anchor, positives=5, negatives_=10, low=30, high=90, scale=256):
    kept = []
    for key, vector, label in rows:
        if key is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((key, label, [math.floor(scale * x) for x in vector]))
    hold = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    out = []
    for i, (key, label, vector) in enumerate(kept):
        if not is_anchor(key):
            continue
        scored = [(-hold(sum(a * b for a, b in zip(vector, v))), k, j, other) for j, (k, other, v) in enumerate(kept) if j != i and len(v) == len(vector)]
        scored.sort(key=lambda s: s[:2])
        for score, k, _, _ in [s for s in scored if s[3] == label][:positives]:
            fit = [(n, s) for s, n, _, other in scored if other != label and low * -score <= 100 * -s <= high * -score][:negatives_]
            out += [(key, k, rank, n, -score, -s) for rank, (n, s) in enumerate(fit, 1)]
    return sorted(out)


def mined(frame, **options):
    found = negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0, **options)
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in found.collect())


@pytest.mark.parametrize("size", [0.5, 300.0, 1e7, 1e30])
def test_negatives_at_any_size(spark, size):
    """Two fields to 64 bits, and wider integers than 64 bits."""
    draw = np.random.default_rng(int(size))
    rows = [(i, [float(x) for x in draw.normal(0.3, 1, 12) * size], i % 3) for i in range(240)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(5)
    expected = brute_negatives(rows, lambda k: k % 10 == 0)
    assert len(expected) > 500 or size > 1e8
    assert mined(frame) == expected


def test_negatives_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TASKS", 5)
    monkeypatch.setattr(negatives, "BLOCK_VALUES", 64)  # many chunks
    monkeypatch.setattr(negatives, "GROUP_VALUES", 16)  # many groups of anchors
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 1.0], 2), (3, [1.0, 1.0], 2), (3, [0.5, 1.0], 2), (None, [9.0, 9.0], 1), (4, None, 1), (5, [1.0, None], 1),
        (6, [1.0, nan], 1), (7, [inf, 1.0], 2), (8, [1.0, 1.0], None), (9, [], 1), (10, [], 1), (20, [1.0], 1), (21, [2.0], 1), (22, [1.0], 3), (30, [-1.0, -2.0], 1), (40, [0.0, 0.0], 1),
        (50, [1.0, 2.0], 7), (60, [0.001, -0.001], 1), (10, [], 1), (11, [], 4), *((100 + i, [0.9, 1.9], 5) for i in range(30)), *((200 + i, [0.5, 0.8], 6) for i in range(30)),
    ]
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id bigint, embedding array<float>, label int, key int, score int, chunk int")
    expected = brute_negatives([(k, None if v is None else [x if x is None else float(np.float32(x)) for x in v], c) for k, v, c in rows], lambda k: k % 10 == 0)
    assert mined(frame.repartition(3)) == expected and len(expected) > 100
    assert mined(frame.limit(0)) == []
    assert mined(frame.filter("embedding is null")) == []


def test_packed_products_are_exact():
    draw = np.random.default_rng(3)
    for high, dim, kind in ((200, 64, np.uint64), (3, 10, np.uint64), (2**20, 64, object)):
        anchors, candidates = draw.integers(-high, high, (7, dim)), draw.integers(-high, high, (41, dim))
        packed = negatives.pack(candidates, anchors)
        assert packed.words.dtype == kind and packed.words.shape[1] < 41
        assert (negatives.products(anchors, packed).astype(object) == anchors.astype(object) @ candidates.astype(object).T).all()


def test_word_vectors_against_a_plain_count(spark):
    texts = ["a b c a", "b b b", None, "", "A1 ?! zz a " * 40, "x y"]
    words = [*classifier.SHAPES, classifier.AGAIN, "a", "b", "?!"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    counts, vectors = classifier.word_vectors(frame, words, "text")
    indexes, seen, sums = classifier.index_vectors(words), Counter(), defaultdict(lambda: np.zeros(classifier.DIMENSIONS))
    for text in texts:
        tokens = classifier.tokens_of(text or "")
        numbers = [words.index(classifier.AGAIN if i and t == tokens[i - 1] else t if t in words else classifier.shape_of(t)) for i, t in enumerate(tokens)]
        seen.update(numbers)
        for i, w in enumerate(numbers):
            for j in range(max(0, i - classifier.WINDOW), min(len(numbers), i + classifier.WINDOW + 1)):
                if i != j:
                    sums[w] += indexes[numbers[j]]
    assert [counts[i] for i in range(len(words))] == [seen[i] for i in range(len(words))]
    for i in range(len(words)):
        plain = sums[i] / max(np.linalg.norm(sums[i]), 1e-9)
        assert np.allclose(vectors[i, : classifier.DIMENSIONS], plain)
    assert all((indexes[i] ** 2).sum() >= 1 for i in range(len(words)))


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    scored = queries.op12_quality_classifier(spark, sf).toPandas()
    assert len(scored) == common.table(spark, sf, "documents").count() and scored["score"].between(0, 1).all()
    assert ((scored["score"] >= 0.3) == (scored["predicted"] == 1)).all()
    assert (scored["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored["doc_id"]]).all()
    judged = scored.merge(common.table(spark, sf, "labels").filter("quality is not null").toPandas(), on="doc_id")
    judged = judged[judged["held_out"]]
    good, bad = judged[judged["quality"] == 1]["score"], judged[judged["quality"] == 0]["score"]
    above = np.mean([(good > b).mean() for b in bad])
    assert above > 0.97 and (judged["predicted"] == judged["quality"]).mean() > 0.95


def test_quality_is_the_same_on_any_layout(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")

    def scores(parts):
        rows = docs.repartition(parts)
        model = classifier.learn_model(rows, classifier.training_sample(rows, labels, None, 1000, "doc_id", "text"))
        return [round(r["score"], 9) for r in classifier.score_documents(rows, model).orderBy("doc_id").collect()]

    assert scores(1) == scores(7)


def test_quality_of_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    docs = spark.createDataFrame(
        [(1, None, 0.1, 2, "k"), (2, "", 0.1, 2, "k"), (2, "two", 0.1, 2, "k"), (None, "| | |", 0.1, 2, "k"), (3, long, 0.1, 2, "k"), (4, "漢字 😀 __ ퟿", 0.1, 2, "k"), (4, " \n", 0.1, 2, "k"), (5, "Of Of Of", 0.1, 2, "k")],
        "doc_id bigint, text string, score double, predicted int, word string",
    )
    labels = spark.createDataFrame([(2, 1, 0), (5, 0, None), (3, None, 1), (None, 1, 1), (2, 0, 1), (99, 1, 0), (4, 1, 1)], "doc_id bigint, quality int, toxic int")
    for lab in (labels, labels.limit(0), labels.filter("doc_id = 4")):
        model = classifier.learn_model(docs, classifier.training_sample(docs, lab, None, 100, "doc_id", "text"))
        found = classifier.score_documents(docs, model).collect()
        assert sorted(str(r["doc_id"]) for r in found) == ["1", "2", "2", "3", "4", "4", "5", "None"]
        assert all(0 <= r["score"] <= 1 for r in found)
    empty = docs.limit(0)
    model = classifier.learn_model(empty, classifier.training_sample(empty, labels.limit(0), None, 100, "doc_id", "text"))
    assert classifier.score_documents(empty, model).count() == 0


def test_pooled_by_hand():
    words = [*classifier.SHAPES, classifier.AGAIN, "a"]
    vectors = np.eye(len(words))
    zero = (np.zeros((10, 1)), np.zeros(1), np.zeros(1), np.zeros(1))
    model = classifier.Model(words, vectors, np.full(len(words), 0.5), np.full(len(words), 0.25), 1.0, np.zeros(10), np.ones(10), zero, 1.0)
    row, none = model.pooled(pa.array(["a a b", None]), classifier.Lookup(words))
    expected = 0.5 * (vectors[words.index("a")] + vectors[words.index(classifier.AGAIN)] + vectors[words.index("<lower>")])
    assert np.allclose(row, [*(expected + 0.25) / 2.5, np.log(4), 1]) and np.allclose(none, [*[0.25] * 8, 0, 0])
