"""Operator 8, best-fit packing: length patterns fitted to the histogram by non-negative least squares."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import slices, workers_see_library
from shelfwise.llm.tokens import ByteLevelEncoder, made_once
from shelfwise.operators.ordering import running_total
from shelfwise.session import materialize

SALTS = 4096  # parts into which the pieces of one length are dealt to number them; a hot length spreads over all tasks


def token_pieces(
    docs: DataFrame, vocabulary: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Each document's ids and `end_id`, cut where longer than `size`: full pieces last, the first takes the rest.

    Null and empty texts are one piece of the end id alone. Repeated rows are cut each. `with_ids` adds the ids.
    """
    spark = docs.sparkSession
    workers_see_library(spark)
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # a vocabulary file: a few MB, whatever the corpus
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = made_once(ByteLevelEncoder, spec.value)
        for part in slices(batches):
            rows, of, ids = [], [], []
            for i, text in enumerate(part.column("text")):
                all_ids = np.array([*encoder.encode(text.as_py()), end_id], "<u4")
                begin, end = 0, (len(all_ids) - 1) % size + 1
                while begin < len(all_ids):
                    own = all_ids[begin:end]
                    of.append(i)
                    rows.append(((begin + size - 1) // size, begin, end - begin, zlib.crc32(own.tobytes())))
                    if with_ids:
                        ids.append(own)
                    begin, end = end, end + size
            piece, start, length, crc = map(list, zip(*rows))
            columns = [part.column("id").take(pa.array(of)), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = f"`{id_col}` {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    return rows.mapInArrow(run, schema)


def full_patterns(lengths: np.ndarray, size: int) -> list[tuple[int, ...]]:
    """Patterns of at most three lengths, longest first, that fill a sequence as well as any third length can.

    Each pair of lengths is completed by the longest one that still fits; a pair that leaves no room stands alone.
    """
    lengths = np.sort(lengths)
    found = {(size,)} if size in lengths else set()
    for a in lengths[lengths < size][::-1]:
        others = lengths[lengths <= min(a, size - a)]
        rest = size - a - others
        at = np.searchsorted(lengths, np.minimum(rest, others), "right") - 1
        third = np.where((at >= 0) & (rest > 0), lengths[np.maximum(at, 0)], 0)
        fill = a + others + third
        good = fill >= size - size // 256
        found.update(tuple(int(x) for x in (a, b, c) if x) for b, c in zip(others[good], third[good]))
    return sorted(found, key=lambda p: (-sum(p), len(p), p))


def least_squares(patterns: list[tuple[int, ...]], histogram: dict[int, int], sweeps: int = 15) -> np.ndarray:
    """Repeat counts x >= 0 that bring the patterns' lengths closest to the histogram: coordinate descent."""
    left = {n: float(c) for n, c in histogram.items()}
    times = [defaultdict(int) for _ in patterns]
    for t, pattern in zip(times, patterns):
        for n in pattern:
            t[n] += 1
    steps = [(tuple(t.items()), 1.0 / sum(v * v for v in t.values())) for t in times]
    x = np.zeros(len(patterns))
    total = sum(histogram.values())
    for _ in range(sweeps):
        moved = 0.0
        for k, (items, scale) in enumerate(steps):
            was = x[k]
            now = was + scale * sum(v * left[n] for n, v in items)
            now = now if now > 0.0 else 0.0
            if now != was:
                for n, v in items:
                    left[n] -= v * (now - was)
                x[k] = now
                moved += abs(now - was)
        if moved < 1e-4 * total:
            break
    return x


def packing_plan(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that use up every piece of the histogram.

    The fitted counts are rounded and held to what there is, best filled patterns first. What is left is packed
    longest first, each gap by the longest length that fits, whole runs of equal sequences at a time: every round
    uses up a length or nearly so, whatever the counts.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    if not left:
        return []
    patterns = full_patterns(np.array(list(left)), size)
    plan = []
    for pattern, want in zip(patterns, least_squares(patterns, left)):
        need = {n: pattern.count(n) for n in pattern}
        repeats = min(int(round(want)), *(left[n] // k for n, k in need.items()))
        if repeats > 0:
            plan.append((pattern, repeats))
            for n, k in need.items():
                left[n] -= k * repeats
    while left := {n: c for n, c in left.items() if c}:
        gap, need, pattern = size, defaultdict(int), []
        for n in sorted(left, reverse=True):
            fits = min(gap // n, left[n])
            need[n] += fits
            pattern += [n] * fits
            gap -= n * fits
        repeats = min(left[n] // k for n, k in need.items() if k)
        plan.append((tuple(pattern), repeats))
        for n, k in need.items():
            left[n] -= k * repeats
    return plan


def place(pieces: DataFrame, plan: list[tuple[tuple[int, ...], int]], id_col: str, salts: int = SALTS) -> DataFrame:
    """Sequence and offset for each piece: its number among those of its length finds its place in the plan."""
    slots: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    base = 0
    for pattern, repeats in plan:
        offset = 0
        for n in pattern:
            slots[n].append((taken[n], base, offset))
            taken[n] += repeats
            offset += n
        base += repeats
    tables = {n: np.array(s, np.int64) for n, s in slots.items()}  # bounded by the patterns, not by the pieces

    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    each = Window.partitionBy("length", "salt").orderBy(id_col, "piece", "start", "ids_crc32")
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    counts = running_total(counts, ["salt"], "n", "upto", ["length"]).select("length", "salt", (F.col("upto") - F.col("n")).alias("base"))
    ranked = salted.withColumn("own", F.row_number().over(each) - 1).join(counts, ["length", "salt"])
    ranked = ranked.select(id_col, "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("own")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = length == n
                rows = tables[int(n)]
                slot = np.searchsorted(rows[:, 0], rank[at], "right") - 1
                sequence[at] = rows[slot, 1] + rank[at] - rows[slot, 0]
                offset[at] = rows[slot, 2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"]
            )

    id_type = pieces.schema[id_col].dataType.simpleString()
    return ranked.mapInArrow(
        run, f"`{id_col}` {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )


def pack(docs: DataFrame, vocabulary: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most `size` tokens: one row per piece with its sequence and offset.

    Texts are turned to ids once; the pieces, without ids, are written to the shared folder. Only the histogram of
    lengths (at most `size` rows) comes to the driver. Null and empty texts are the end id alone; null ids stay null;
    repeated rows are packed each; an empty table gives an empty table; other columns are ignored.
    """
    pieces = materialize(token_pieces(docs, vocabulary, size, end_id, id_col, text_col), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    return place(pieces, packing_plan(histogram, size), id_col)
