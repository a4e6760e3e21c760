"""Operator 6, benchmark decontamination: suffix arrays of the training texts, searched for every test suffix."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import ALNUM, slices, words_of, workers_see_library

BLOCK_CHARS = 4_000_000  # test text that is sent to the workers at once; a larger test set goes in several blocks
SHARD_BYTES = 1 << 20  # training text of one suffix array, or one text
LEAD = 3  # words by which places are chosen for the suffix array

_RESULT = "n_words bigint, runs array<struct<begin:int,end:int>>, items array<string>, longest int, longest_at int, longest_item string"


class TestSet(NamedTuple):
    """Words of the test items as numbers from 1 (0 ends a text), and their suffixes' first words as sorted keys."""

    vocabulary: np.ndarray  # sorted word hashes
    words: np.ndarray  # numbers of all items' words
    item_ends: np.ndarray  # for each place, where its item ends
    item_of: np.ndarray
    names: np.ndarray
    keys: np.ndarray  # distinct keys of the searched suffixes, sorted
    upper: np.ndarray  # what a key's range ends with
    depth: np.ndarray  # words of each key: the window, or all of a shorter item
    first_suffix: np.ndarray  # suffixes of key k: suffixes[first_suffix[k] : first_suffix[k + 1]]
    suffixes: np.ndarray
    leads: np.ndarray  # sorted lead hashes
    short_leads: np.ndarray  # numbers of the first words of items with fewer words than a lead


def _keys(numbers: np.ndarray, at: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """The next `window` words of each place as bytes that sort as the suffixes do; 0 from the text's end on."""
    padded = np.concatenate([numbers, np.zeros(window, numbers.dtype)])
    columns = np.arange(window)
    rows = np.where(at[:, None] + columns < ends[:, None], padded[at[:, None] + columns], 0).astype(">u4")
    return np.ascontiguousarray(rows).view(f"S{4 * window}").ravel()


def _leads(numbers: np.ndarray) -> np.ndarray:
    """A hash of each place's first LEAD words (exact below 2**21 words in the vocabulary)."""
    n = np.concatenate([numbers, np.zeros(LEAD - 1, numbers.dtype)]).astype(np.uint64)
    total = np.zeros(len(numbers), np.uint64)
    for k in range(LEAD):
        total = total * np.uint64(1 << 21) + n[k : len(numbers) + k]
    return total


def _isin(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def prepare_tests(names: list[str], texts: list[str | None], window: int) -> TestSet:
    words = words_of(pa.array(texts, pa.string()), ALNUM)
    counts = np.diff(words.first)
    vocabulary = np.unique(words.hashes)
    numbers = (np.searchsorted(vocabulary, words.hashes) + 1).astype(np.uint32)
    item_of = np.repeat(np.arange(len(counts)), counts)
    ends = np.repeat(words.first[1:], counts)
    begins = np.repeat(words.first[:-1], counts)
    at = np.arange(len(numbers))
    searched = np.flatnonzero((ends - at >= window) | ((at == begins) & (ends - begins < window)))
    depth = np.minimum(ends[searched] - searched, window)
    keys, first, inverse = np.unique(_keys(numbers, searched, ends[searched], window), return_index=True, return_inverse=True)
    depth = depth[first]
    suffixes = searched[np.argsort(inverse, kind="stable")]
    upper = np.frombuffer(keys.astype(f"S{4 * window}").tobytes(), ">u4").reshape(-1, window).copy()
    upper[np.arange(window) >= depth[:, None]] = 0xFFFFFFFF
    upper = np.ascontiguousarray(upper).view(f"S{4 * window}").ravel()
    long_enough = ends[searched] - searched >= LEAD
    return TestSet(
        vocabulary, numbers, ends, item_of, np.array(names, object), keys, upper, depth,
        np.concatenate([[0], np.cumsum(np.bincount(inverse, minlength=len(keys)))]), suffixes,
        np.unique(_leads(numbers)[searched[long_enough]]), np.unique(numbers[searched[~long_enough]]),
    )


def match_shard(texts: pa.Array, tests: TestSet, window: int) -> list[tuple]:
    """(n_words, runs, items, longest, longest_at, longest_item) per text.

    The shard's suffix array holds the places whose first words begin some searched test suffix; other places cannot
    match a window. Each test suffix is found by binary search: its matches are a range of the array.
    """
    words = words_of(texts, ALNUM)
    counts = np.diff(words.first)
    n = len(words.hashes)
    found = [(int(c), [], [], 0, None, None) for c in counts]
    if not n or not len(tests.keys):
        return found
    place = np.minimum(np.searchsorted(tests.vocabulary, words.hashes), len(tests.vocabulary) - 1)
    numbers = np.where(tests.vocabulary[place] == words.hashes, place + 1, 0).astype(np.uint32)
    at = np.flatnonzero(_isin(_leads(numbers), tests.leads) | _isin(numbers, tests.short_leads))
    if not len(at):
        return found
    owner = np.searchsorted(words.first, at, "right") - 1
    text_ends = words.first[owner + 1]
    keys = _keys(numbers, at, text_ends, window)
    order = np.argsort(keys, kind="stable")
    suffix_array, keys = at[order], keys[order]
    low, high = np.searchsorted(keys, tests.keys, "left"), np.searchsorted(keys, tests.upper, "right")
    sizes = high - low
    key = np.repeat(np.arange(len(tests.keys)), sizes)
    if not len(key):
        return found
    ranks = np.arange(len(key)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[key]
    begin = suffix_array[ranks]
    text = np.searchsorted(words.first, begin, "right") - 1
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + tests.depth[key], -1)
    hit = np.concatenate([[False], np.cumsum(change)[:-1] > 0, [False]])
    # each match with each test suffix of that key; then how far the match goes on
    own = np.diff(tests.first_suffix)[key]
    match = np.repeat(np.arange(len(key)), own)
    suffix = tests.suffixes[np.arange(len(match)) - np.repeat(np.cumsum(own) - own, own) + tests.first_suffix[key[match]]]
    length = tests.depth[key[match]].copy()
    alive = np.arange(len(match))
    text_end = words.first[text[match] + 1]
    while len(alive):
        p, q = begin[match[alive]] + length[alive], suffix[alive] + length[alive]
        inside = (p < text_end[alive]) & (q < tests.item_ends[suffix[alive]])
        alive, p, q = alive[inside], p[inside], q[inside]
        alive = alive[numbers[p] == tests.words[q]]
        length[alive] += 1
    item = tests.item_of[suffix]
    pairs = np.unique(np.stack([text[match], item], 1), axis=0)
    best = np.lexsort((item, begin[match], -length, text[match]))
    _, first_of = np.unique(text[match][best], return_index=True)
    for b in best[first_of]:
        t = int(text[match[b]])
        c, base = found[t][0], words.first[t]
        inside = np.concatenate([[False], hit[1 + base : 1 + base + c], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        runs = [{"begin": int(x), "end": int(y)} for x, y in zip(edges[::2], edges[1::2])]
        low_pair, high_pair = np.searchsorted(pairs[:, 0], [t, t + 1])
        names = [tests.names[i] for i in pairs[low_pair:high_pair, 1]]
        found[t] = (c, runs, names, int(length[b]), int(begin[match[b]] - base), tests.names[item[b]])
    return found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[tuple[list[str], list[str]]]:
    """The test set in blocks of about `block_chars`; never more than one block is on the driver."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        yield [r["item"] for r in rows], [r["text"] for r in rows]


def _in_turn(sent: list) -> Iterator[TestSet]:
    """The blocks of tests one after another; of several, a worker holds one at a time and reads the next from its disk."""
    for block in sent:
        yield block.value if len(sent) == 1 else block.load_from_path(block._path) if block._path else block.value


def _united(found: list[list[tuple]]) -> list[tuple]:
    """What the blocks found in each text, together: all runs and items, and the longest match, the first one of equal length."""
    if len(found) == 1:
        return found[0]
    texts = []
    for parts in zip(*found):
        matched = [p for p in parts if p[4] is not None]
        best = max(matched, key=lambda p: (p[3], -p[4], p[5]), default=parts[0])
        texts.append((parts[0][0], [r for p in parts for r in p[1]], [i for p in parts for i in p[2]], *best[3:]))
    return texts


def _matched(docs: DataFrame, sent: list, window: int, text_col: str, columns: list[str]) -> DataFrame:
    """The named columns of the documents, and the matches with all blocks of tests. The documents are read once."""
    kinds = ", ".join(f"`k{i}` {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(columns))
    result = pa.schema([
        ("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string())),
        ("longest", pa.int32()), ("longest_at", pa.int32()), ("longest_item", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SHARD_BYTES):
            found = _united([match_shard(part.column("text"), tests, window) for tests in _in_turn(sent)])
            made = [pa.array(c, f.type) for c, f in zip(zip(*found), result)]
            kept = [part.column(f"k{i}") for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=[*(f"k{i}" for i in range(len(columns))), *result.names])

    rows = docs.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(columns)), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"{kinds}, {_RESULT}")


def _judged(matched: DataFrame) -> DataFrame:
    """Adds n_hit, n_items, items_sha256 and contaminated to runs and items."""
    step = lambda done, r: F.struct(
        (done["n"] + F.greatest(r["end"] - F.greatest(r["begin"], done["reach"]), F.lit(0))).cast("bigint").alias("n"),
        F.greatest(done["reach"], r["end"]).alias("reach"),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("reach"))
    names = F.sort_array(F.array_distinct("items"))
    return (
        matched.withColumn("n_hit", F.aggregate(F.sort_array("runs"), start, step)["n"])
        .withColumn("n_items", F.size(names).cast("bigint"))
        .withColumn("items_sha256", F.sha2(F.array_join(names, ",").cast("binary"), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, and its longest verbatim match with its place.

    Null and empty texts have no words and no hits; items without words match nothing; a null item id is named "null".
    Repeated documents are judged each, repeated items name one item. An empty test set contaminates nothing. Columns
    in `keep` (the id, if not given) are carried along; other columns are ignored, whatever their names.

    The training texts are read once and not shuffled: each shard makes its suffix array and is searched for all test
    suffixes, block after block where the test set is above `block_chars`. The driver and a worker hold one block each.
    """
    spark = docs.sparkSession
    workers_see_library(spark)
    keep = [id_col] if keep is None else keep
    sent = [spark.sparkContext.broadcast(prepare_tests(names, texts, window)) for names, texts in _blocks(benchmark, item_col, item_text_col, block_chars)]
    carried = [f"k{i}" for i in range(len(keep))]
    matched = _matched(docs, sent, window, text_col, keep)
    judged = _judged(matched)
    return judged.select(
        *(F.col(k).alias(c) for k, c in zip(carried, keep)),
        *("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest", "longest_at", "longest_item"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with their columns. Rows with a null id are judged like others."""
    names = [f"__{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    at = {c: n for c, n in zip(docs.columns, names)}
    judged = find_contamination(plain, benchmark, id_col=at[id_col], text_col=at[text_col], keep=names, **options)
    return judged.filter(~F.col("contaminated")).select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
