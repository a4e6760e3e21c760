"""Operator 11, spelling variants: PartEnum signatures of letter multisets, joined by equality and verified by edit distance."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import STEPS, mix, slices, workers_see_library
from shelfwise.session import materialize

LEAST_CHARS = 6  # code points of a word, at least
LEAST_COUNT = 5  # occurrences of a word over all documents, at least
RATIO = 5  # a form occurs so many times as often as its word, at least
SLIP = 199  # one run in so many loses a code point
DISTANCE = 2  # one insertion or deletion changes one element of the multiset, a replacement two
PARTS = 5  # parts of the binary vector: of any PARTS - DISTANCE some are equal
HELD_WORDS = 400_000  # distinct words that a task holds before it hands its counts on

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_SUBSETS = tuple(combinations(range(PARTS), PARTS - DISTANCE))


def count_words(docs: DataFrame, id_col: str, text_col: str, slip: int, least_chars: int) -> DataFrame:
    """(word, n) over all whole texts: lower-cased runs of letters, of which one in `slip` loses a code point.

    A task adds up what it reads before anything is shuffled, so a word that fills a third of the corpus is one row a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def hand_on() -> pa.RecordBatch:
            words, counts = list(held), list(held.values())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])

        for part in slices(batches):
            for key, text in zip(part.column("id").to_pylist(), part.column("text")):
                start = crc32(f"{key}:".encode())
                for word, n in Counter(_RUN.findall((text.as_py() or "").translate(_LOWER))).items():
                    if len(word) < least_chars:
                        continue
                    h = crc32(word.encode(), start)
                    if not h % slip:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= least_chars:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield hand_on()
        if held:
            yield hand_on()

    rows = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _spread(values: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Sums of 64-bit values by owner, modulo 2 ** 64. Owners ascend."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    first = np.searchsorted(owner, np.arange(size + 1))
    return sums[first[1:]] - sums[first[:-1]]


def signatures(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the word, shorter length of the pairs meant, key): the words that may be one edit apart share a key.

    PartEnum: the elements of a word's binary vector are (letter, its first, second, ... copy). They are dealt into
    PARTS parts; two vectors that differ in at most DISTANCE places agree on PARTS - DISTANCE parts at least, so each
    such choice of parts is a signature. As one edit leaves the first or the last half of the shorter word as it is, a
    key also holds the one or the other half, with the shorter word's length.
    """
    lengths = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n, first = len(words), np.concatenate([[0], np.cumsum(lengths)])
    owner = np.repeat(np.arange(n), lengths)
    place = np.arange(len(codes)) - first[owner]

    order = np.lexsort((codes, owner))
    new = np.concatenate([[True], (codes[order][1:] != codes[order][:-1]) | (owner[order][1:] != owner[order][:-1])])
    since = np.maximum.accumulate(np.where(new, np.arange(len(codes)), 0))
    copy = (np.arange(len(codes)) - since).astype(np.uint64)
    element = mix(codes[order] * STEPS[10] + copy * STEPS[11] + np.uint64(7))
    part = (element >> np.uint64(20)) % np.uint64(PARTS)
    parts = np.stack([_spread(np.where(part == k, element, np.uint64(0)), owner, n) for k in range(PARTS)])
    chosen = [mix(sum(parts[k] * STEPS[20 + k] for k in subset) + np.uint64(number)) for number, subset in enumerate(_SUBSETS)]

    powers = np.cumprod(np.full(max(int(lengths.max(initial=0)), 1), STEPS[12]), dtype=np.uint64)
    ahead = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(codes) * powers[place], dtype=np.uint64)])
    back = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(codes) * powers[lengths[owner] - 1 - place], dtype=np.uint64)])
    rows, shorter, keys = [], [], []
    for less in (0, 1):
        size = lengths - less
        half = size // 2
        halves = (ahead[first[:-1] + half] - ahead[first[:-1]], back[first[1:]] - back[first[1:] - half])
        for side, value in enumerate(halves):
            here = mix(value * STEPS[13] + size.astype(np.uint64) * STEPS[14] + np.uint64(side))
            for signature in chosen:
                rows.append(np.arange(n))
                shorter.append(size)
                keys.append(mix(here + signature).view(np.int64))
    return np.concatenate(rows), np.concatenate(shorter), np.concatenate(keys)


def near_words(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b), both ways: the words exactly one inserted, deleted or replaced code point apart, each pair once.

    Words are joined by equal keys; the join's own condition verifies the edit distance, so that no pair that only
    shares a bucket becomes a row. Both sides are plain exchanges: adaptive execution splits a hot key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "word", 1 << 16):
            number, shorter, keys = signatures(part.column("word").to_pylist())
            at = pa.array(number)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(shorter), part.column("word").take(at), part.column("n").take(at)], names=["key", "shorter", "word", "n"])

    signed = words.mapInArrow(run, "key bigint, shorter bigint, word string, n bigint")
    size = F.char_length("word")
    one = signed.filter(size == F.col("shorter")).select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    two = signed.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), (size > F.col("shorter")).alias("longer"))
    verified = (F.col("longer") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    joined = one.join(two.hint("merge"), (one["key"] == two["key"]) & verified)
    pairs = materialize(joined.select("a", "n_a", "b", "n_b").distinct(), "near-words")
    return pairs.union(pairs.select("b", "n_b", "a", "n_a"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word reached by following forms. A form is RATIO times as frequent, so chains end.

    Every round doubles the steps taken; it goes on until nothing changes.
    """
    reached = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        reached = moved.select("word", "root")
        if moved.filter("moved").limit(1).count() == 0:
            return reached


def group_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, ratio: int = RATIO, slip: int = SLIP
) -> DataFrame:
    """word, n, form, form_n, root and n_near of every word with `least_chars` code points and `least_count` occurrences.

    Words are runs of letters (Latin, with accents), only A-Z lowered; one run in `slip`, chosen by the checksum of id
    and run, loses a code point first. `n_near` counts the words at edit distance one. `form` is the most frequent of
    them (ties: the least in code-point order) if it occurs `ratio` times as often as the word, else null; `root` is
    reached by following forms, the word itself if it has none.

    Null and empty texts have no words; a null id counts as an empty one; repeated rows count each; an empty table, or
    one without frequent words, gives an empty table; other columns are ignored. Very long runs are words like others.

    Texts are read once and never shuffled: a task adds its words up. What is shuffled are counts and, of frequent words
    only, 40 keys each. A bucket whose words are permutations of one another is compared pair by pair inside the join.
    """
    workers_see_library(docs.sparkSession)
    words = materialize(count_words(docs, id_col, text_col, slip, least_chars).filter(F.col("n") >= least_count), "words")
    best = F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form"))).alias("best")
    near = near_words(words).groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best)
    form_n = -F.col("best.less")
    judged = words.join(near, "word", "left").withColumn("has", F.coalesce(form_n >= ratio * F.col("n"), F.lit(False)))
    judged = judged.select(
        "word", "n", F.when(F.col("has"), F.col("best.form")).alias("form"), F.when(F.col("has"), form_n).alias("form_n"), F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near")
    )
    judged = materialize(judged, "judged-words")
    rooted = judged.join(roots(judged.filter(F.col("form").isNotNull())), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
