"""Nearest texts by a bounded index: a tree over blocks of texts, walked only where it can still add something.

Texts that share rare words lie in one block. A node of the tree knows the
largest weight that any text below it has for a word, so the words of a text
bound what it can find there. A text first looks into its own block; the k-th
best found there is what anything else has to reach. From the root on it then
follows only nodes whose bound does, and compares itself with the blocks that
are left. The answer is that of comparing everything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.ordering import number_rows
from shelfwise.session import materialize, workers_see_library

DECIMALS = 6
SLACK = 1e-6  # two rounded cosines may differ from their bounds by so much
BLOCK_TEXTS = 512
BLOCK_WORDS = 1 << 17  # words of a block's texts, at most (or one text)
FAN = 16  # children of a node
ASKED = 4096  # texts that look into a block together
BATCH = 128


def _blocks(vectors: DataFrame, id_type: str) -> DataFrame:
    """(block, ids, sizes, words, weights): texts in the order of their words, the rarest first, cut into blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = batch.column("words").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends, begin = np.cumsum(sizes), 0
            while begin < batch.num_rows:
                before = ends[begin - 1] if begin else 0
                stop = max(begin + 1, min(begin + BLOCK_TEXTS, int(np.searchsorted(ends, before + BLOCK_WORDS, "right"))))
                part = batch.slice(begin, stop - begin)
                values = [part.column("text_id"), pa.array(sizes[begin:stop]), *(part.column(c).flatten() for c in ("words", "weights"))]
                listed = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in values]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *listed], names=["block", "ids", "sizes", "words", "weights"])
                number, begin = number + 1, stop

    ordered = vectors.repartitionByRange("words").sortWithinPartitions("words").select("text_id", "words", "weights")
    return ordered.mapInArrow(run, f"block bigint, ids array<{id_type}>, sizes array<bigint>, words array<bigint>, weights array<double>")


def _products(asked: pa.Table, block: pa.Table) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(some asking texts, their products with each entry of the block): added up by arrays, in batches."""
    words, weights = (block.column(c)[0].values.to_numpy() for c in ("words", "weights"))
    sizes = np.asarray(block.column("sizes")[0].values)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(words, kind="stable")
    words, weights, owner = words[order], weights[order], owner[order]
    for begin in range(0, asked.num_rows, BATCH):
        part = asked.slice(begin, BATCH).combine_chunks()
        lists = part.column("words").combine_chunks(), part.column("weights").combine_chunks()
        mine, own = (c.flatten().to_numpy() for c in lists)
        row = np.repeat(np.arange(part.num_rows), lists[0].value_lengths().to_numpy(zero_copy_only=False))
        low, high = np.searchsorted(words, mine, "left"), np.searchsorted(words, mine, "right")
        met = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(met)[:-1]]), met) + np.arange(met.sum())
        sums = np.bincount(np.repeat(row, met) * len(sizes) + owner[at], np.repeat(own, met) * weights[at], part.num_rows * len(sizes))
        yield part, sums.reshape(part.num_rows, len(sizes))


def _compare(asked: pa.Table, block: pa.Table, k: int, id_kind: pa.DataType) -> pa.Table:
    """(text_id, neighbour_id, cosine): for each asking text the k best other texts of a block that reach its bound."""
    out: list[tuple] = []
    if asked.num_rows and block.num_rows:
        ids = block.column("ids")[0].values
        rank = np.empty(len(ids), np.int64)  # ties go to the lower id
        rank[np.asarray(pc.array_sort_indices(ids))] = np.arange(len(ids))
        names = ids.to_pylist()
        place = {name: i for i, name in enumerate(names)}
        for part, cosines in _products(asked, block):
            cosines = np.round(cosines, DECIMALS)
            for i, (name, bound) in enumerate(zip(part.column("text_id").to_pylist(), part.column("bound").to_pylist())):
                fit = np.flatnonzero((cosines[i] > 0) & (cosines[i] >= bound))
                fit = fit[fit != place.get(name, -1)]
                if len(fit) > k:
                    fit = fit[cosines[i][fit] >= np.partition(cosines[i][fit], len(fit) - k)[len(fit) - k]]
                for j in fit[np.lexsort((rank[fit], -cosines[i][fit]))][:k].tolist():
                    out.append((name, names[j], float(cosines[i][j])))
    columns = list(zip(*out)) if out else [(), (), ()]
    return pa.Table.from_arrays([pa.array(columns[0], id_kind), pa.array(columns[1], id_kind), pa.array(columns[2], pa.float64())], names=["text_id", "neighbour_id", "cosine"])


def _able(asked: pa.Table, block: pa.Table, id_kind: pa.DataType) -> pa.Table:
    """(text_id, place, bound): for each asking text the nodes below one whose largest weights still reach its bound."""
    texts, nodes, bounds = [pa.array([], id_kind)], [np.zeros(0, np.int64)], [np.zeros(0)]
    if asked.num_rows and block.num_rows:
        children = np.asarray(block.column("ids")[0].values)
        for part, most in _products(asked, block):
            bound = part.column("bound").to_numpy()
            row, child = np.nonzero((most > 0) & (most >= bound[:, None] - SLACK))
            texts.append(part.column("text_id").combine_chunks().take(pa.array(row)))
            nodes.append(children[child])
            bounds.append(bound[row])
    return pa.Table.from_arrays([pa.concat_arrays(texts), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(bounds))], names=["text_id", "place", "bound"])


def _node(level: pa.Table) -> pa.Table:
    """The children of one node as a block: for each its words with their largest weights."""
    level = level.sort_by([("child", "ascending")])
    children, sizes = np.unique(level.column("child").to_numpy(), return_counts=True)
    values = [pa.array(children), pa.array(sizes), level.column("word").combine_chunks(), level.column("top").combine_chunks()]
    listed = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in values]
    return pa.Table.from_arrays([level.column("node").slice(0, 1), *listed], names=["place", "ids", "sizes", "words", "weights"])


def nearest(vectors: DataFrame, k: int, floor: float = 0.0, probes: DataFrame | None = None, enough: float | None = None) -> DataFrame:
    """(text_id, neighbour_id, cosine, rank): the ``k`` best other texts of each text, or of each of ``probes`` (text_id).

    ``vectors`` has a row (text_id, words, weights) for each distinct text: word numbers in ascending order, the rarest
    first, and weights of norm 1. Cosines are rounded to six decimals; ties go to the lower id; texts without a shared
    word, or below ``floor``, are no neighbours. A probe that has ``k`` neighbours of more than ``enough`` in its own
    block looks no further; its list then is right in saying so, not in naming the best.
    """
    workers_see_library(vectors.sparkSession)
    id_type = vectors.schema["text_id"].dataType.simpleString()
    id_kind = vectors.select("text_id").limit(0).toArrow().schema.field("text_id").type
    vectors = vectors.select("text_id", "words", "weights")
    blocks = materialize(_blocks(vectors, id_type), "text-blocks")
    places = materialize(number_rows(blocks.select("block"), ["block"], "place", start=0), "places")
    blocks = blocks.join(places, "block").drop("block")
    n_blocks = places.count()
    home = materialize(blocks.select("place", F.explode("ids").alias("text_id")), "homes")
    asked = vectors if probes is None else vectors.join(probes.select("text_id").distinct(), "text_id", "left_semi")
    asked = materialize(asked, "asked")
    salts = max(1, -(-asked.count() // ASKED))

    def meet(frontier: DataFrame, blocks: DataFrame, work, schema: str) -> DataFrame:
        """What the texts of (place, text_id, bound) find in those blocks. Many that ask for one block are several groups."""
        frontier = materialize(frontier.select("place", "text_id", "bound", F.pmod(F.xxhash64("text_id"), F.lit(salts)).alias("salt")), "frontier")
        meetings = frontier.select(F.col("place").alias("at"), F.col("salt").alias("part")).distinct()
        copies = meetings.join(blocks, F.col("at") == F.col("place")).select("at", "part", "ids", "sizes", "words", "weights")
        rows = frontier.join(asked, "text_id").groupBy("place", "salt").cogroup(copies.groupBy("at", "part"))
        return rows.applyInArrow(work, schema)

    def look(frontier: DataFrame) -> DataFrame:
        return meet(frontier, blocks, lambda a, b: _compare(a, b.slice(0, 1), k, id_kind), f"text_id {id_type}, neighbour_id {id_type}, cosine double")

    bound = F.lit(float(floor))
    first = materialize(look(home.join(asked.select("text_id"), "text_id").withColumn("bound", bound)), "near-home")
    by_rank = Window.partitionBy("text_id").orderBy(F.desc("cosine"), "neighbour_id")
    if n_blocks > 1:
        reached = first.groupBy("text_id").agg(F.count(F.lit(1)).alias("n"), F.min("cosine").alias("least"))
        kth = F.when(F.col("n") >= k, F.greatest("least", bound)).otherwise(bound)
        open_ = asked.join(reached, "text_id", "left").withColumn("bound", F.coalesce(kth, bound))
        if enough is not None:
            open_ = open_.filter((F.coalesce("n", F.lit(0)) < k) | (F.col("least") <= enough))
        open_ = materialize(open_.select("text_id", "bound"), "open")
        leaf = blocks.select("place", F.explode(F.arrays_zip("words", "weights")).alias("w")).groupBy(F.col("place").alias("node"), F.col("w.words").alias("word"))
        levels = [materialize(leaf.agg(F.max("w.weights").alias("top")), "bounds")]
        while FAN ** len(levels) < n_blocks:
            higher = levels[-1].groupBy(F.floor(F.col("node") / FAN).alias("node"), "word").agg(F.max("top").alias("top"))
            levels.append(materialize(higher, "bounds"))
        frontier = open_.withColumn("place", F.lit(0).cast("bigint"))
        for level in reversed(levels):
            children = level.select(F.floor(F.col("node") / FAN).alias("node"), F.col("node").alias("child"), "word", "top")
            nodes = materialize(children.groupBy("node").applyInArrow(_node, "place bigint, ids array<bigint>, sizes array<bigint>, words array<bigint>, weights array<double>"), "nodes")
            frontier = materialize(meet(frontier, nodes, lambda a, b: _able(a, b.slice(0, 1), id_kind), f"text_id {id_type}, place bigint, bound double"), "able")
        first = first.unionByName(look(frontier.join(home, ["place", "text_id"], "left_anti")))
    return materialize(first.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= k), "nearest")
