"""Operator 13, hard negatives: exact integer inner products, several candidates to one wide integer (Kronecker packing)."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import workers_see_library
from shelfwise.session import materialize

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score between which a negative's score lies
BLOCK_VALUES = 1 << 17  # components that are written as one row
CHUNK_VALUES = 1 << 22  # components of candidates that a task holds at once
GROUP_VALUES = 1 << 17  # components of anchors that a task holds at once
TASKS = 64  # small tables are cut finer than CHUNK_VALUES, into so many chunks
TILE = 32  # anchors scored at once
WIDE_FIELDS = 8  # candidates to one integer where two do not fit 64 bits


class Packed(NamedTuple):
    """Candidates' components, `fields` candidates to an integer: the fields lie `width` bits apart and never overflow."""

    words: np.ndarray  # dimensions x integers
    fields: int
    width: int
    size: int  # candidates
    sums: np.ndarray  # of each candidate's components
    bias: int  # added to each component of a candidate
    anchor_bias: int


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """64-bit integers where they hold every value (whole doubles), else Python's own integers."""
    if not values.size or np.abs(values).max() < 2.0**53:
        return values.astype(np.int64)
    return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)


def pack(candidates: np.ndarray, anchors: np.ndarray) -> Packed:
    """Pack rows of integers for products with the given anchors.

    Components of both sides are biased to be at least 0, so a field of a sum of products lies between 0 and its bound,
    and neighbours do not touch. 64-bit integers hold two candidates or more for components as embeddings have them;
    larger ones take Python's integers, of any width.
    """
    size, dim = candidates.shape
    both = [x if x.size else np.zeros((1, 1), np.int64) for x in (candidates, anchors)]
    bias, anchor_bias = (max(0, -int(x.min())) for x in both)
    bound = dim * (int(both[0].max()) + bias) * (int(both[1].max()) + anchor_bias)
    width = max(1, max(bound, 0).bit_length())
    narrow = width <= 32 and candidates.dtype != object and anchors.dtype != object
    fields, kind = (64 // width, np.uint64) if narrow else (WIDE_FIELDS, object)
    if not narrow:
        candidates = candidates.astype(object)
    held = -(-size // fields) * fields
    biased = np.zeros((held, dim), kind)
    biased[:size] = (candidates + bias).astype(kind)
    biased = biased.reshape(held // fields, fields, dim)
    words = np.zeros((biased.shape[0], dim), kind)
    for field in range(fields):
        words |= biased[:, field] << (np.uint64(field * width) if narrow else field * width)
    return Packed(np.ascontiguousarray(words.T), fields, width, size, candidates.sum(1) if dim else np.zeros(size, np.int64), bias, anchor_bias)


def products(anchors: np.ndarray, packed: Packed) -> np.ndarray:
    """Exact inner products, a row per anchor and a column per candidate: one multiplication per anchor component and integer."""
    dim, integers = packed.words.shape
    narrow = packed.words.dtype != object
    anchors = anchors.astype(np.int64 if narrow else object)
    lifted = (anchors + packed.anchor_bias).astype(packed.words.dtype)
    total = np.zeros((len(anchors), integers), packed.words.dtype)
    step = np.empty_like(total)
    for k in range(dim):
        np.multiply(lifted[:, k, None], packed.words[k], out=step)
        total += step
    mask = (1 << packed.width) - 1
    scores = np.zeros((len(anchors), integers, packed.fields), np.int64 if narrow else object)
    for field in range(packed.fields):
        shift = field * packed.width
        scores[:, :, field] = (total >> np.uint64(shift)) & np.uint64(mask) if narrow else (total >> shift) & mask
    scores = scores.reshape(len(anchors), -1)[:, : packed.size]
    own = anchors.sum(1) if dim else np.zeros(len(anchors), np.int64)
    # sum (a + A)(b + B) = sum ab + A sum b + B sum a + dim A B
    return scores - packed.anchor_bias * packed.sums - (packed.bias * own + dim * packed.anchor_bias * packed.bias)[:, None]


def best(scores: np.ndarray, places: np.ndarray, most: int) -> np.ndarray:
    """Of the places the `most` of highest score, ties by place."""
    if len(places) > most:
        mine = scores[places]
        places = places[mine >= np.partition(mine, len(mine) - most)[len(mine) - most]]
    return places[np.lexsort((places, ~scores[places]))][:most]  # ~x is -x - 1, of any x


def _blocks(rows: DataFrame, scale: int) -> DataFrame:
    """Rows that take part as (block, dim, size, n_anchors, row numbers, ids, labels, anchors, values), a few thousand to a row.

    Values are written with two bytes where they fit, else as doubles, which hold the floor of a double exactly.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        number = 0
        for batch in batches:
            vectors = batch.column("vector")
            size = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = vectors.flatten()
            values = np.floor(np.asarray(pc.fill_null(flat, float("nan")), np.float64) * float(scale))
            first = np.concatenate([[0], np.cumsum(size)])
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            good = bad[first[1:]] == bad[first[:-1]]
            ids, labels = (batch.column(c).to_numpy() for c in ("id", "label"))
            anchors = batch.column("anchor").to_numpy(zero_copy_only=False).astype(bool)
            for dim in np.unique(size[good]).tolist():
                here = np.flatnonzero(good & (size == dim))
                step = max(1, BLOCK_VALUES // max(dim, 1))
                for begin in range(0, len(here), step):
                    mine = here[begin : begin + step]
                    held = values[first[mine][:, None] + np.arange(dim)]
                    narrow = not held.size or np.abs(held).max() < 2**15
                    keys = (task << 40) + number + np.arange(len(mine))
                    number += len(mine)
                    yield pa.RecordBatch.from_pydict({
                        "block": [int(keys[0])], "dim": pa.array([dim], pa.int32()), "size": pa.array([len(mine)], pa.int32()), "n_anchors": pa.array([int(anchors[mine].sum())], pa.int32()),
                        "keys": [keys.astype("<i8").tobytes()], "ids": [ids[mine].astype("<i8").tobytes()], "labels": [labels[mine].astype("<i8").tobytes()],
                        "anchors": [anchors[mine].tobytes()], "data": [held.astype("<i2" if narrow else "<f8").tobytes()],
                    })

    schema = "block bigint, dim int, size int, n_anchors int, keys binary, ids binary, labels binary, anchors binary, data binary"
    return rows.mapInArrow(run, schema)


def _values(data: bytes, size: int, dim: int) -> np.ndarray:
    kind = "<i2" if len(data) == 2 * size * dim else "<f8"
    return np.frombuffer(data, kind).astype(np.float64).reshape(size, dim)


def _anchor_rows(blocks: DataFrame) -> DataFrame:
    """(key, id, label, dim, data) of each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = np.flatnonzero(np.frombuffer(row["anchors"], bool))
                ids, keys, labels = (np.frombuffer(row[c], "<i8")[at] for c in ("ids", "keys", "labels"))
                each = len(row["data"]) // row["size"] if row["dim"] else 0
                data = [row["data"][i * each : (i + 1) * each] for i in at.tolist()]
                yield pa.RecordBatch.from_pydict({"key": keys, "id": ids, "label": labels, "dim": pa.array([row["dim"]] * len(at), pa.int32()), "data": pa.array(data, pa.binary())})

    return blocks.filter("n_anchors > 0").mapInArrow(run, "key bigint, id bigint, label bigint, dim int, data binary")


def _meet(anchors: DataFrame, blocks: DataFrame, groups: int, chunks: int, pick, schema: str) -> DataFrame:
    """Every group of anchors with every chunk of candidates: `pick` gets the anchors' rows, candidates and scores of a tile.

    Neither side is broadcast or joined row by row: a task holds one group and one chunk, whatever the tables' sizes.
    """
    names = [x.split()[0] for x in schema.split(", ")]

    def run(_key: tuple, asked: pa.Table, given: pa.Table) -> pa.Table:
        out: list[tuple] = []
        asked = asked.to_pylist()
        given = given.to_pylist()
        for dim in {a["dim"] for a in asked}:
            mine, theirs = [a for a in asked if a["dim"] == dim], [b for b in given if b["dim"] == dim]
            if not theirs:
                continue
            keys, ids, labels = (np.concatenate([np.frombuffer(b[c], "<i8") for b in theirs]) for c in ("keys", "ids", "labels"))
            order = np.lexsort((keys, ids))
            candidates = whole_numbers(np.concatenate([_values(b["data"], b["size"], dim) for b in theirs])[order])
            questions = whole_numbers(np.concatenate([_values(a["data"], 1, dim) for a in mine]))
            packed = pack(candidates, questions)
            for begin in range(0, len(mine), TILE):
                scores = products(questions[begin : begin + TILE], packed)
                if scores.dtype == object:
                    scores = np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64)
                for anchor, row in zip(mine[begin : begin + TILE], scores):
                    out += pick(anchor, keys[order], ids[order], labels[order], row)
        columns = list(zip(*out)) if out else [()] * len(names)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    left = anchors.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups).cast("bigint"))).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = blocks.withColumn("chunk", F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))
    return left.groupBy("group", "chunk").cogroup(right.groupBy("group", "chunk")).applyInArrow(run, schema)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Components become floor(scale * x); a score is the exact integer inner product of two rows, higher first, ties by
    smaller id. An anchor's positives are its first `positives` other rows of the same label; for each of them come the
    first `negatives` rows of another label with low * positive_score <= 100 * negative_score <= high * positive_score.

    Rows with a null id, label or vector, or a null or non-finite component (scaled: the same) take no part. Vectors are
    compared with those of equal length only; empty ones score 0. Repeated rows are rows of their own: each can be a
    positive or a negative, and each anchor row gets its results. An anchor without positives or fitting rows gives no
    row; an empty table gives none. Products are exact at any size; a score beyond 64 bits counts as the nearest number of
    64 bits. Other columns are ignored.

    The anchors are the stated query set against all rows: groups of anchors meet chunks of candidates, each pair a
    task's work of bounded size, first for positives, then for negatives within the positives' windows. A label that a
    third of the rows have makes no larger group. The best few of each chunk are merged by anchor.
    """
    workers_see_library(vectors.sparkSession)
    rows = vectors.select(
        vectors[id_col].cast("bigint").alias("id"), vectors[label_col].cast("bigint").alias("label"), vectors[vector_col].cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor")
    )
    blocks = materialize(_blocks(rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()), scale), "vector-blocks")
    sizes = blocks.agg(F.sum(F.col("size") * F.greatest("dim", F.lit(1))), F.sum(F.col("n_anchors") * F.greatest("dim", F.lit(1)))).first()
    total, asked = int(sizes[0] or 0), int(sizes[1] or 0)
    chunks = max(1, -(-total // CHUNK_VALUES), min(TASKS, -(-total // BLOCK_VALUES)))
    groups = max(1, -(-asked // GROUP_VALUES))
    anchors = materialize(_anchor_rows(blocks), "anchors")

    def same_label(anchor: dict, keys: np.ndarray, ids: np.ndarray, labels: np.ndarray, scores: np.ndarray) -> list[tuple]:
        places = best(scores, np.flatnonzero((labels == anchor["label"]) & (keys != anchor["key"])), positives)
        return [(anchor["key"], ids[p], keys[p], scores[p]) for p in places.tolist()]

    found = _meet(anchors, blocks, groups, chunks, same_label, "key bigint, id bigint, other bigint, score bigint")
    by_score = lambda keys: Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "other")
    chosen = found.withColumn("place", F.row_number().over(by_score(["key"]))).filter(F.col("place") <= positives)
    chosen = materialize(chosen.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("chosen")), "positives")  # at most `positives`

    def in_window(anchor: dict, keys: np.ndarray, ids: np.ndarray, labels: np.ndarray, scores: np.ndarray) -> list[tuple]:
        out, apart = [], labels != anchor["label"]
        for positive in anchor["chosen"]:
            limit = positive["score"]
            least, most = (min(max(x, -(2**63)), 2**63 - 1) for x in (-(-low * limit // 100), high * limit // 100))  # rounded up, rounded down
            places = best(scores, np.flatnonzero(apart & (scores >= least) & (scores <= most)), negatives)
            out += [(anchor["key"], anchor["id"], positive["place"], positive["id"], limit, ids[p], keys[p], scores[p]) for p in places.tolist()]
        return out

    schema = "key bigint, anchor_id bigint, place bigint, positive_id bigint, positive_score bigint, id bigint, other bigint, score bigint"
    mined = _meet(anchors.join(chosen.hint("merge"), "key"), blocks, groups, chunks, in_window, schema)
    ranked = mined.withColumn("rank", F.row_number().over(by_score(["key", "place"]))).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
