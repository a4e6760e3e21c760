"""What several operators of this subpackage share: words of whole texts as arrays, byte-bounded slices, Python paths."""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20  # text bytes that one vectorised step takes at once; a longer text is a slice of its own

_RANDOM = np.random.default_rng(20240229)
_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _BASE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
STEPS = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)  # one odd factor per place in a window


def workers_see_library(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it (elsewhere it is sent with --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def byte_classes(separators: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(is a word byte, code of the byte). Bytes from 0x80 on are word bytes: separators are ASCII, so UTF-8 allows it."""
    is_word = np.ones(256, bool)
    is_word[list(separators)] = False
    code = np.arange(256)
    if lower:
        code[65:91] += 32
    return is_word, _CODES[code]


SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: Words `[^\x20\x09-\x0D]+` with A-Z lowered.
SPACED = byte_classes(SPACES, True)
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` with A-Z lowered first, so that A-Z are word bytes.
ALNUM = byte_classes(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), True)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words(NamedTuple):
    """Words of some texts, one after another. Text i has words first[i] to first[i + 1]."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray  # byte places in `data`
    ends: np.ndarray
    data: np.ndarray


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        if size > SLICE_BYTES + 1:
            return tables[0], tables[1]  # not kept: only one text needs it
        _powers[:] = tables
    return _powers[0], _powers[1]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string array; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def words_of(texts: pa.Array, classes: tuple[np.ndarray, np.ndarray]) -> Words:
    """All words of the texts as 64-bit hashes, by array operations on the UTF-8 bytes."""
    data, at = text_bytes(texts)
    n = len(data)
    inside = classes[0][data]
    begin, end = inside.copy(), inside.copy()
    if n:
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edges = at[:-1][at[:-1] < n]
        begin[edges] = inside[edges]
        edges = at[1:][at[1:] > 0] - 1
        end[edges] = inside[edges]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    powers, inverses = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(classes[1][data] * powers[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverses[starts])
    return Words(hashes, np.searchsorted(starts, at), starts, ends, data)


def windows_of(words: Words, size: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text numbers) of all windows of `size` words; with `short`, a text of fewer words is one window."""
    counts = np.diff(words.first)
    n = len(words.hashes)
    owner = np.repeat(np.arange(len(counts)), counts)
    if n >= size:
        total = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            total += words.hashes[k : n - size + 1 + k] * STEPS[k]
        whole = owner[: n - size + 1] == owner[size - 1 :]
        hashes, owners = total[whole], owner[: n - size + 1][whole]
    else:
        hashes, owners = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if short:
        for have in range(1, size):
            texts = np.flatnonzero(counts == have)
            total = np.full(len(texts), 2 * have + 1, np.uint64)
            for k in range(have):
                total += words.hashes[words.first[texts] + k] * STEPS[k]
            hashes, owners = np.concatenate([hashes, total]), np.concatenate([owners, texts])
    return mix(hashes), owners


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut to slices of at most `limit` bytes of text, or one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            base = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(begin, stop - begin)
            begin = stop
