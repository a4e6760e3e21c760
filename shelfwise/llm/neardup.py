"""Operator 2, near-duplicates: HyperMinHash registers, banded with a prefix filter, then verified on full sets."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import SPACED, STEPS, mix, slices, windows_of, words_of, workers_see_library
from shelfwise.session import materialize

REGISTER_BITS = 7  # 128 registers
MANTISSA_BITS = 18  # kept below the leading zeros, of which there are at most 57: 6 bits
BAND = 2  # registers of a band
SIGMAS = 4.5  # margin of the sketch filters: a pair at the threshold is missed about 3 times in a million
BLOCK = 512  # members of a bucket that are compared with as many others at once
FINE = 1024  # one-byte registers by which members of one bucket are compared
EMPTY = np.uint32(0xFFFFFFFF)

_REGISTERS = 1 << REGISTER_BITS
_REST = 64 - REGISTER_BITS


def registers(hashes: np.ndarray, owners: np.ndarray, texts: int) -> np.ndarray:
    """One row of registers per text: of each bucket's least hash, leading zeros and the mantissa bits that follow.

    A register is ordered as the hash is: fewer zeros are a larger value. EMPTY marks a bucket without a hash.
    """
    slot = owners.astype(np.int64) * _REGISTERS + (hashes & np.uint64(_REGISTERS - 1)).astype(np.int64)
    rest = hashes >> np.uint64(REGISTER_BITS)
    least = np.full(texts * _REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, slot, rest)
    some = least != np.iinfo(np.uint64).max
    value = least[some]
    length = np.zeros(len(value), np.int64)  # bits from the leading one on
    at = value.copy()
    for step in (32, 16, 8, 4, 2, 1):
        more = at >= np.uint64(1 << step)
        length += np.where(more, step, 0)
        at = np.where(more, at >> np.uint64(step), at)
    length += at > 0
    shift = length - 1 - MANTISSA_BITS
    mantissa = np.where(shift >= 0, value >> np.maximum(shift, 0).astype(np.uint64), value << np.maximum(-shift, 0).astype(np.uint64)) & np.uint64((1 << MANTISSA_BITS) - 1)
    found = np.full(texts * _REGISTERS, EMPTY, np.uint32)
    found[some] = (length.astype(np.uint64) << np.uint64(MANTISSA_BITS) | mantissa).astype(np.uint32)
    return found.reshape(texts, _REGISTERS)


def estimates(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard similarity by equal registers less expected chance collisions, registers in use), row by row."""
    used = ((a != EMPTY) | (b != EMPTY)).sum(1)
    equal = ((a == b) & (a != EMPTY)).sum(1)
    n, m = np.maximum(n_a, n_b).astype(float), np.minimum(n_a, n_b).astype(float)
    chance = 0.169919487159739 * 2.0 ** (REGISTER_BITS - MANTISSA_BITS + 1) * (4 * n / m) / (1 + n / m) ** 2  # for unlike sets, as published with the sketch
    chance = chance * used / _REGISTERS * (1 - equal / np.maximum(used, 1))
    return (equal - chance) / np.maximum(used, 1), used


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first places): the distinct shingles of each text, sorted within the text."""
    hashes, owners = windows_of(words_of(texts, SPACED), size)
    order = np.argsort(owners, kind="stable")  # in order but for short texts, which come last
    hashes, owners = hashes[order], owners[order]
    first = np.searchsorted(owners, np.arange(len(texts) + 1))
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        hashes[begin:end].sort()
    if len(hashes):
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])])
        kept = np.concatenate([[0], np.cumsum(new)])
        hashes, first = hashes[new], kept[first]
    return hashes, first


def sketch(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, a 128-bit digest of the set, and its registers, of every whole text. No shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashes, first = shingle_sets(part.column("text"), size)
            counts = np.diff(first)
            owners = np.repeat(np.arange(len(counts)), counts)
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + STEPS[k]), dtype=np.uint64)]) for k in (40, 41)]
            digests = [pa.array((s[first[1:]] - s[first[:-1]]).view(np.int64)) for s in sums]
            made = registers(hashes, owners, len(counts)).astype("<u4")
            sketches = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * _REGISTERS), len(counts), [None, pa.py_buffer(made.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(counts.astype(np.int64)), *digests, sketches], names=["id", "n", "d1", "d2", "registers"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, n bigint, d1 bigint, d2 bigint, registers binary")


def _as_registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, _REGISTERS)


def band_tokens(sketches: DataFrame) -> DataFrame:
    """(id, n, bands, token): a hash of the band's number and registers for each band with a register in use."""
    id_type = sketches.schema["id"].dataType.simpleString()
    bands = _REGISTERS // BAND

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _as_registers(batch.column("registers")).reshape(-1, bands, BAND)
            used = (values != EMPTY).any(2)
            total = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), used.shape).copy()
            for k in range(BAND):
                total = mix(total * STEPS[50] + values[:, :, k].astype(np.uint64))
            row, _ = np.nonzero(used)
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(taken), batch.column("n").take(taken), pa.array(used.sum(1).astype(np.int32)[row]), pa.array(total[used].view(np.int64))],
                names=["id", "n", "bands", "token"],
            )

    return sketches.select("id", "n", "registers").mapInArrow(run, f"id {id_type}, n bigint, bands int, token bigint")


def prefix_index(tokens: DataFrame, threshold: float) -> DataFrame:
    """(id, n, own, token): for each text its rarest tokens, as few as any partner must share one of.

    A partner has equal bands at a rate of threshold ** BAND or more, so at least `least` of a text's bands, with the
    margin of SIGMAS. Of tokens in a global order (rarest first) the first bands - least + 1 must then hold a common
    one. Tokens that one text alone has come first in that order and need no row; `own` counts them.
    """
    shared = materialize(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("freq")).filter("freq > 1"), "shared-tokens")
    rate = threshold**BAND
    least = F.greatest(F.lit(1), F.floor(F.col("bands") * rate - SIGMAS * F.sqrt(F.col("bands") * rate * (1 - rate))))
    lists = (
        tokens.join(shared, "token")
        .groupBy("id")
        .agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.sort_array(F.collect_list(F.struct("freq", "token"))).alias("held"))  # at most 64
    )
    own = F.col("bands") - F.size("held")
    rows = lists.select("id", "n", own.alias("own"), F.slice("held", F.lit(1), F.greatest(F.lit(0), F.col("bands") - least + 1 - own).cast("int")).alias("held"))
    return rows.select("id", "n", "own", F.explode(F.col("held.token")).alias("token"))


def _likely(n_a: Column, n_b: Column, threshold: float) -> Column:
    return F.least(n_a, n_b) >= F.lit(threshold) * F.greatest(n_a, n_b) - 1e-9


def _above(value: np.ndarray, used: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether an estimate allows the threshold. Registers in use are drawn from the union without putting back."""
    union = np.maximum((n_a + n_b) / (1 + threshold), 2.0)
    left = np.clip((union - used) / (union - 1), 0.0, 1.0)
    used = np.maximum(used, 1)
    return value >= threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) / used * left) - 2.0 / used


def fine_registers(hashes: np.ndarray, owners: np.ndarray, texts: int) -> np.ndarray:
    """One row of FINE bytes per text: of each bucket's least hash a fingerprint from 1 to 255; 0 for none."""
    slot = owners.astype(np.int64) * FINE + (hashes % np.uint64(FINE)).astype(np.int64)
    least = np.full(texts * FINE, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, slot, hashes)
    prints = (mix(least + STEPS[51]) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    prints[least == np.iinfo(np.uint64).max] = 0
    return prints.reshape(texts, FINE)


def fine_sketches(texts: DataFrame, size: int) -> DataFrame:
    """(id, n, fine) of the texts that share a bucket with others."""
    id_type = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashes, first = shingle_sets(part.column("text"), size)
            made = fine_registers(hashes, np.repeat(np.arange(part.num_rows), np.diff(first)), part.num_rows)
            rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(FINE), part.num_rows, [None, pa.py_buffer(made.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("id"), rows], names=["id", "fine"])

    return texts.mapInArrow(run, f"id {id_type}, fine binary")


def _fine_estimates(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    used = ((a | b) != 0).sum(1)
    equal = ((a == b) & (a != 0)).sum(1)
    return (equal - (used - equal) / 254) / np.maximum(used, 1), used


def sketch_filter(pairs: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose estimated similarity is not below the threshold by more than the margin."""
    id_type = pairs.schema["a"].dataType.simpleString()
    side = lambda k: sketches.select(F.col("id").alias(k), F.col("n").alias(f"n_{k}"), F.col("registers").alias(f"r_{k}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sizes = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
                value, used = estimates(_as_registers(batch.column("r_a")), _as_registers(batch.column("r_b")), *sizes)
                yield batch.select(["a", "b"]).filter(pa.array(_above(value, used, *sizes, threshold)))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(run, f"a {id_type}, b {id_type}")


def verify(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets have 100 * intersection >= percent * union."""
    id_type = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict = OrderedDict()  # sets of texts just seen: a centre meets many partners

        def set_of(key, text: pa.Scalar) -> np.ndarray:
            if key not in recent:
                recent[key] = shingle_sets(pa.array([text.as_py()], pa.string()), size)[0]
                if len(recent) > 64:
                    recent.popitem(last=False)
            return recent[key]

        for batch in batches:
            keep = []
            for a, b, x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("text_a"), batch.column("text_b")):
                one, two = set_of(a, x), set_of(b, y)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda k: texts.select(F.col("id").alias(k), F.col("text").alias(f"text_{k}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b").mapInArrow(run, f"a {id_type}, b {id_type}")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for every end of an edge: the smallest id reachable.

    Labels fall to the least of the neighbours and then to their label's own label, so long chains halve, until nothing
    changes. Every round is a table in the shared folder; only whether there was a change comes to the driver.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), name)
    while True:
        offered = both.join(labels.select(F.col("id").alias("b"), F.col("component").alias("c")), "b").groupBy(F.col("a").alias("id")).agg(F.min("c").alias("c"))
        lower = labels.join(offered, "id").select("id", F.col("component").alias("old"), F.least("component", "c").alias("component"))
        lower = materialize(lower, name)
        onward = lower.select(F.col("id").alias("component"), F.col("component").alias("next"))
        labels = materialize(lower.join(onward, "component").select("id", "old", F.col("next").alias("component")), name)
        if labels.filter("old <> component").limit(1).count() == 0:
            return labels.select("id", "component")
        labels = labels.select("id", "component")


def bucket_meetings(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members by block, meetings of blocks) of the buckets whose members (id, n, token, component) are not all linked.

    A component with BLOCK members or more in a bucket has blocks of its own, the smaller ones share blocks. Two blocks of
    one component never meet. So one text that is apart from a large group meets each of the group's blocks once, and the
    group's blocks do not meet each other.
    """
    sizes = placed.groupBy("token", "component").agg(F.count(F.lit(1)).alias("size"))
    mixed = sizes.groupBy("token").agg(F.count(F.lit(1)).alias("parts"), F.sum(F.when(F.col("size") < BLOCK, F.col("size"))).alias("pooled")).filter("parts > 1")
    sizes = materialize(sizes.join(mixed.select("token", "pooled"), "token"), "bucket-parts")
    count = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    large = sizes.filter(F.col("size") >= BLOCK).select("token", F.col("component").alias("owner"), count("size").alias("blocks"))
    shared = sizes.filter(F.col("size") < BLOCK).groupBy("token").agg(F.first("pooled").alias("pooled")).select("token", F.lit(None).cast(sizes.schema["component"].dataType).alias("owner"), count("pooled").alias("blocks"))
    every = large.union(shared).select("token", "owner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("number"))
    every = every.select("token", "owner", F.xxhash64("owner", "number").alias("block"))
    one, two = every.alias("one"), every.alias("two")
    apart = F.col("one.owner").isNull() | F.col("two.owner").isNull() | (F.col("one.owner") != F.col("two.owner"))
    met = one.join(two, (F.col("one.token") == F.col("two.token")) & (F.col("one.block") <= F.col("two.block")) & apart)
    met = materialize(met.select("one.token", F.col("one.block").alias("low"), F.col("two.block").alias("high")), "meetings")
    big = F.col("size") >= BLOCK
    number = F.when(big, F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / BLOCK))).otherwise(F.pmod(F.xxhash64("component"), F.ceil(F.col("pooled") / BLOCK))).cast("int")
    members = placed.join(sizes, ["token", "component"]).select("id", "n", "token", "component", F.xxhash64(F.when(big, F.col("component")), number).alias("block"))
    return members, met


def cross_pairs(index: DataFrame, centres: DataFrame, labels: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of one bucket and different components that the sketches cannot rule out.

    Pairs with the bucket's centre have been judged. A bucket whose other members are all linked already gives nothing,
    however large. Of others, blocks of members meet (see `bucket_meetings`), each two in a task that compares registers
    as arrays and emits only likely pairs, so no pair is a joined row. Of the buckets that two texts share, the one of
    the least token emits them.
    """
    id_type = index.schema["id"].dataType.simpleString()
    placed = index.join(centres.select("token", F.col("centre.id").alias("c")), "token").filter("id <> c").select("id", "n", "token")
    placed = placed.join(labels, "id", "left").select("id", "n", "token", F.coalesce("component", "id").alias("component"))
    placed, met = bucket_meetings(materialize(placed, "placed"))
    placed = materialize(placed, "members")
    tokens_of = placed.groupBy("id").agg(F.collect_set("token").alias("tokens"))  # at most as many as bands
    sides = met.select("token", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"), F.struct("low", "high").alias("met"))
    sides = sides.groupBy("token", "block").agg(F.collect_list("met").alias("met"))  # one for each block that it meets
    members = placed.join(sides, ["token", "block"]).join(sketches.join(tokens_of, "id"), "id")
    members = members.select("id", "n", "component", "fine", "tokens", "token", "block", F.inline("met"))
    meeting = ["token", "low", "high"]
    members = members.repartition(*meeting).sortWithinPartitions(*meeting)
    id_kind = pa.int64() if id_type == "bigint" else pa.int32()

    def compare(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Likely pairs of two blocks of one bucket (rows with one token, low and high)."""
        ids, n, component, blocks = (part.column(c).to_numpy() for c in ("id", "n", "component", "block"))
        values = np.frombuffer(b"".join(part.column("fine").to_pylist()), np.uint8).reshape(-1, FINE)
        some = np.ascontiguousarray(values[:, ::8])
        tokens, token = [set(x) for x in part.column("tokens").to_pylist()], part.column("token")[0].as_py()
        low, high = part.column("low")[0].as_py(), part.column("high")[0].as_py()
        i, j = (x.ravel() for x in np.meshgrid(np.flatnonzero(blocks == low), np.flatnonzero(blocks == high), indexing="ij"))
        fit = (component[i] != component[j]) & (np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]) - 1e-9)
        fit &= (i < j) if low == high else True
        i, j = i[fit], j[fit]
        found = []
        for begin in range(0, len(i), 4096):
            p, q = i[begin : begin + 4096], j[begin : begin + 4096]
            for registers_ in (some, values):  # an eighth of the registers rules out most pairs
                good = _above(*_fine_estimates(registers_[p], registers_[q]), n[p], n[q], threshold)
                p, q = p[good], q[good]
            here = np.array([min(tokens[x] & tokens[y]) == token for x, y in zip(p.tolist(), q.tolist())], bool)
            found.append((ids[p[here]], ids[q[here]]))
        a, b = (np.concatenate(x) for x in zip(*found)) if found else (ids[:0], ids[:0])
        return np.minimum(a, b), np.maximum(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []  # rows of a meeting that may go on in the next batch
        for batch in chain(batches, [None]):
            if batch is not None and batch.num_rows:
                rest.append(batch)
            if not rest or (batch is not None and not batch.num_rows):
                continue
            rows = pa.concat_batches(rest) if len(rest) > 1 else rest[0]
            keys = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in meeting], 1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            edges = [0, *edges.tolist(), len(keys)] if batch is None else [0, *edges.tolist()]
            rest = [rows.slice(edges[-1])] if edges[-1] < len(keys) else []
            pairs = [compare(rows.slice(x, y - x)) for x, y in zip(edges, edges[1:]) if y - x > 1]
            if pairs:
                a, b = (np.concatenate(x) for x in zip(*pairs))
                yield pa.RecordBatch.from_arrays([pa.array(a, id_kind), pa.array(b, id_kind)], names=["a", "b"])

    return members.mapInArrow(run, f"a {id_type}, b {id_type}")


def link_copies(docs: DataFrame, size: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id, kept for every row: near-duplicates by 100 * intersection >= percent * union.

    Ids are numbers. Texts without words (null, empty) have 0 shingles and are linked with nothing. Repeated rows share
    their id's component; an id with several texts is linked by any of them. A null id takes no part: its component is
    null and it is kept.
    An empty table gives an empty table; other columns are ignored, whatever their names.

    1. Sketch every text; texts of equal sets are one class, named by its smallest id, so exact copies cost nothing more.
    2. Band the registers; index each class under its rarest bands (see `prefix_index`).
    3. In each bucket pair every member with the most typical one (fewest bands of its own); filter by sketch, verify
       on full sets, and find components. A group of any size costs a row per member and bucket.
    4. Compare members of one bucket that are still apart (see `cross_pairs`), verify, find components again.

    Only texts that share a bucket are shuffled as texts, once; all else are ids, tokens and registers.
    """
    workers_see_library(docs.sparkSession)
    threshold = percent / 100
    features = materialize(sketch(docs, size, id_col, text_col), "sketches")
    with_id = features.filter(F.col("id").isNotNull() & (F.col("n") > 0))
    classes = materialize(with_id.groupBy("d1", "d2", "n").agg(F.min("id").alias("id"), F.first("registers").alias("registers")), "classes")
    index = materialize(prefix_index(band_tokens(classes), threshold), "index")

    centre = F.min(F.struct("own", "id", "n")).alias("centre")
    centres = materialize(index.groupBy("token").agg(centre, F.count(F.lit(1)).alias("members")).filter("members > 1"), "centres")
    met = index.join(centres, "token").select("id", "n", F.col("centre.id").alias("c"), F.col("centre.n").alias("n_c"))
    stars = met.filter((F.col("id") != F.col("c")) & _likely(F.col("n"), F.col("n_c"), threshold)).select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).distinct()

    in_buckets = index.join(centres.select("token"), "token", "left_semi").select("id").distinct()
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(in_buckets, "id", "left_semi")
    once = texts.filter(F.col("text").isNotNull()).groupBy("id", F.xxhash64("text").alias("digest")).agg(F.first("text").alias("text"))
    texts = materialize(once.select("id", "text"), "texts")

    first = materialize(verify(sketch_filter(stars, classes, threshold), texts, size, percent), "links")
    likely = materialize(cross_pairs(index, centres, components(first), fine_sketches(texts, size), threshold), "likely")
    second = materialize(verify(likely, texts, size, percent), "links")
    found = components(first.union(second))

    named = classes.select("d1", "d2", "n", F.col("id").alias("class_id")).join(found.withColumnRenamed("id", "class_id"), "class_id", "left")
    named = materialize(named.select("d1", "d2", "n", F.coalesce("component", "class_id").alias("component")), "named")
    rows = features.select("id", "n", "d1", "d2").join(named, ["d1", "d2", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("id").isNull() | (F.col("id") == component)).alias("kept"))


def drop_copies(docs: DataFrame, size: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose id names their component, with their columns; rows with a null id stay."""
    dropped = link_copies(docs, size, percent, id_col, text_col).filter(~F.col("kept")).select(id_col).distinct()
    return docs.join(dropped, id_col, "left_anti").select(*docs.columns)
