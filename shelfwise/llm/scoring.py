"""Operator 1, LM scoring: cross-entropy difference of matched target and background bigram models."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import SLICE_BYTES, SPACED, STEPS, Words, mix, slices, words_of, workers_see_library
from shelfwise.session import materialize

KEY_BITS = 64  # words and word pairs are known by hashes of so many bits
MIXTURE = 0.6  # share of the bigram estimate in the interpolation
ADDED = 0.5  # added to each unigram count
BLOCK_BYTES = 8 << 20  # text bytes that ask for their counts together; a longer text is a block of its own
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
FAN_BITS = 8  # a block sends its grams in 2 ** FAN_BITS cells a kind; so many blocks, and then so many groups, are added up at once
CELL = "grp bigint, slot bigint, sender bigint, kind int, size bigint, keys binary, counts array<binary>"


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def grams_of(words: Words, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word key, pair key, text number) of every word; a text's first word follows the text's start."""
    owner = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    before = _before(words)
    return words.hashes & _mask(bits), mix(before * STEPS[61] + words.hashes * STEPS[62]) & _mask(bits), owner


def _before(words: Words) -> np.ndarray:
    before = np.concatenate([np.zeros(1, np.uint64), words.hashes[:-1]]) if len(words.hashes) else words.hashes.copy()
    before[words.first[:-1][np.diff(words.first) > 0]] = STEPS[60]
    return before


def contexts_of(words: Words, bits: int) -> np.ndarray:
    """The key of the word before each word (of the start for first words)."""
    return _before(words) & _mask(bits)


def _marked(target: DataFrame, id_col: str) -> DataFrame:
    """The target's ids, to be joined by sorting: they grow with the corpus, so no size of them is broadcast."""
    return target.select(F.col(id_col).alias("id")).distinct().withColumn("target", F.lit(True)).hint("merge")


@contextmanager
def _shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a finished write go at once: what was written is read from its table."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, one at least, by as many bytes as the largest needs: all lowest bytes first, compressed."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, size: int) -> np.ndarray:
    planes = pa.decompress(data[1:], size * data[0], codec="zstd", asbytes=True)
    out = np.zeros((size, 8), np.uint8)
    out[:, : data[0]] = np.frombuffer(planes, np.uint8).reshape(data[0], size).T
    return out.view("<u8").reshape(size)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences."""
    return pack(np.diff(keys, prepend=np.zeros(1, np.uint64)))


def unpack_keys(data: bytes, size: int) -> np.ndarray:
    return np.cumsum(unpack(data, size), dtype=np.uint64)


class Block:
    """Distinct grams of some texts with their counts. Kind 0: words and the start, with counts as word and as context; 1: pairs.

    `counts[kind]` has a row for each of n_background, n_target (and again as context); `at` is where each word's
    gram, pair and context stand in `keys`.
    """

    def __init__(self, texts: pa.RecordBatch, bits: int) -> None:
        parts = [(np.diff(w.first), *grams_of(w, bits)[:2], contexts_of(w, bits)) for w in (words_of(p.column("text"), SPACED) for p in slices(iter([texts])))]
        join = lambda k, kind: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kind)
        one, two, context = join(1, np.uint64), join(2, np.uint64), join(3, np.uint64)
        self.n = join(0, np.int64)
        self.owner = np.repeat(np.arange(len(self.n)), self.n)
        chosen = texts.column("target").to_numpy(zero_copy_only=False).astype(bool)[self.owner]
        words, inverse = np.unique(np.concatenate([one, context, STEPS[60:61] & _mask(bits)]), return_inverse=True)
        pairs, pair_at = np.unique(two, return_inverse=True)
        self.keys, self.at = (words, pairs), (inverse[: len(one)], pair_at, inverse[len(one) : 2 * len(one)])
        tally = lambda at, size: [np.bincount(at, minlength=size), np.bincount(at[chosen], minlength=size)]
        self.counts = (
            np.array(tally(self.at[0], len(words)) + tally(self.at[2], len(words))),
            np.array(tally(pair_at, len(pairs))),
        )

    def own(self, k: int) -> np.ndarray:
        """For each word, how often its text holds its word (0), pair (1) or context (2)."""
        _, inverse, counts = np.unique(self.owner * (len(self.keys[k % 2]) + 1) + self.at[k], return_inverse=True, return_counts=True)
        return counts[inverse]


def _texts(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


def _cells(rows: list[tuple]) -> list[pa.Array]:
    group, slot, sender, kind, size, keys, counts = zip(*rows) if rows else ((),) * 7
    return [*(pa.array(x, pa.int64()) for x in (group, slot, sender)), pa.array(kind, pa.int32()), pa.array(size, pa.int64()), pa.array(keys, pa.binary()), pa.array(counts, pa.list_(pa.binary()))]


NAMES = ["id", "n_words", "target_loss", "background_loss", "score"]
CELL_NAMES = ["grp", "slot", "sender", "kind", "size", "keys", "counts"]


def text_blocks(docs: DataFrame, target: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """(block, bytes, payload): texts with their ids and whether they are target, compressed together."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(_marked(target, id_col), "id", "left")
    rows = rows.select("id", F.coalesce("target", F.lit(False)).alias("target"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 33)
        held: list[pa.RecordBatch] = []
        size = 0

        def block() -> pa.RecordBatch:
            texts = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, texts.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(texts)
            return pa.RecordBatch.from_arrays([pa.array([next(number)]), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "bytes", "payload"])

        for part in slices(batches, limit=min(SLICE_BYTES, block_bytes)):
            more = int(pc.sum(pc.binary_length(part.column("text"))).as_py() or 0)
            if held and size + more > block_bytes:
                yield block()
                held, size = [], 0
            held.append(part)
            size += more
        if held:
            yield block()

    return rows.mapInArrow(run, "block bigint, bytes bigint, payload binary")


def _dealt(keys: np.ndarray, counts: np.ndarray, shift: int, bits: int) -> Iterator[tuple]:
    """(slot, size, keys, counts) of ascending keys, packed: a cell for each value of their bits above `shift`."""
    slots = keys >> np.uint64(shift) if shift < 64 else np.zeros(len(keys), np.uint64)
    begins = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]])) if len(keys) else np.zeros(0, np.int64)
    for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(keys)]):
        yield int(slots[a]), b - a, pack_keys(keys[a:b]), [pack(c[a:b]) for c in counts]


def _added(cells: pa.Table, kind: int) -> tuple[list[int], list[int], np.ndarray, np.ndarray, list[np.ndarray]] | None:
    """(senders, sizes, keys of them all, place of each sender's keys among them one after another, sums) of one kind."""
    mine = cells.filter(pc.equal(cells.column("kind"), kind)).select(["sender", "size", "keys", "counts"])
    senders, sizes = mine.column("sender").to_pylist(), mine.column("size").to_pylist()
    if not sizes:
        return None
    keys, at = np.unique(np.concatenate([unpack_keys(x.as_py(), n) for x, n in zip(mine.column("keys"), sizes)]), return_inverse=True)
    packed = [x.as_py() for x in mine.column("counts")]
    sums = []
    for k in range(len(packed[0])):
        given = np.concatenate([unpack(x[k], n) for x, n in zip(packed, sizes)])
        sums.append(np.bincount(at, given, len(keys)).astype(np.int64))
    return senders, sizes, keys, at, sums


def block_cells(blocks: DataFrame, bits: int, groups: int, fan_bits: int) -> DataFrame:
    """The grams of every block with their counts, by group of blocks and slot (range of keys): a fixed number of cells a block."""
    shift = max(bits - fan_bits, 0)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, number, payload in zip(batch.column("grp").to_pylist(), batch.column("block").to_pylist(), batch.column("payload")):
                block = Block(_texts(payload.as_py()), bits)
                rows = [(group, slot, number, kind, *cell) for kind in (0, 1) for slot, *cell in _dealt(block.keys[kind], block.counts[kind], shift, bits)]
                yield pa.RecordBatch.from_arrays(_cells(rows), names=CELL_NAMES)

    return blocks.select(F.pmod(F.xxhash64("block"), F.lit(groups).cast("bigint")).alias("grp"), "block", "payload").mapInArrow(ask, CELL)


def answer_cells(cells: DataFrame, bits: int, groups: int, fan_bits: int, tasks: int, level: int = 1) -> DataFrame:
    """For every cell the counts over all senders of its grams, in the order of its keys and without them.

    The cells of one group and slot are added up together. Where there are several groups, their sums are senders in
    turn: in groups of groups, and in slots of as many finer ranges, so that a cell keeps its size and a task its load
    however large the corpus is. `tasks` is about the number of blocks, so that a task gets a few blocks' grams. What comes back is handed on to the senders by the places of their keys. A gram that
    every block holds is a number in a cell of each; its sums are made by group, then by group of groups.

    The rows with sender -1, -2 and -3 have as size a slot's number of distinct words, of all words and of the target's.
    """

    def final(key: tuple, given: pa.Table) -> pa.Table:
        rows, (group, slot) = [], (k.as_py() for k in key)
        for kind in (0, 1):
            if (added := _added(given, kind)) is None:
                continue
            senders, sizes, _, at, sums = added
            if not kind:
                every = int((sums[0] > 0).sum()), int(sums[0].sum()), int(sums[1].sum())
                rows += [(group, slot, -1 - i, 0, n, b"", []) for i, n in enumerate(every)]
            begin = 0
            for sender, n in zip(senders, sizes):
                own, begin = at[begin : begin + n], begin + n
                rows.append((group, slot, sender, kind, n, b"", [pack(t[own]) for t in sums]))
        return pa.Table.from_arrays(_cells(rows), names=CELL_NAMES)

    dealt = cells.repartition(tasks, "grp", "slot").groupBy("grp", "slot")
    if groups == 1:
        return dealt.applyInArrow(final, CELL)

    shift, above = max(bits - fan_bits * (level + 1), 0), -(-groups >> fan_bits)

    def merge(key: tuple, given: pa.Table) -> pa.Table:
        """The sums as a cell with sender -1, and for each sender the places of its keys in it, as its keys."""
        rows, (group, slot) = [], (k.as_py() for k in key)
        for kind in (0, 1):
            if (added := _added(given, kind)) is None:
                continue
            senders, sizes, keys, at, sums = added
            rows.append((group, slot, -1, kind, len(keys), pack_keys(keys), [pack(t) for t in sums]))
            begin = 0
            for sender, n in zip(senders, sizes):
                own, begin = at[begin : begin + n], begin + n
                rows.append((group, slot, sender, kind, n, pack_keys(own.astype(np.uint64)), []))
        return pa.Table.from_arrays(_cells(rows), names=CELL_NAMES)

    def onward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                counts = np.stack([unpack(c, row["size"]) for c in row["counts"]])
                rows += [(row["above"], slot, row["grp"], row["kind"], *cell) for slot, *cell in _dealt(unpack_keys(row["keys"], row["size"]), counts, shift, bits)]
            yield pa.RecordBatch.from_arrays(_cells(rows), names=CELL_NAMES)

    def hand_back(key: tuple, asked: pa.Table, answers: pa.Table) -> pa.Table:
        rows, (group, slot) = [], (k.as_py() for k in key)
        answers = answers.sort_by([("fine", "ascending")])
        for kind in (0, 1):
            mine = answers.filter(pc.equal(answers.column("kind"), kind))
            sizes, packed = mine.column("size").to_pylist(), mine.column("counts").to_pylist()
            sums = [np.concatenate([unpack(x[k], n) for x, n in zip(packed, sizes)]) for k in range(len(packed[0]) if packed else 0)]
            for row in asked.filter(pc.equal(asked.column("kind"), kind)).to_pylist():
                own = unpack_keys(row["keys"], row["size"]).astype(np.int64)
                rows.append((group, slot, row["sender"], kind, row["size"], b"", [pack(t[own]) for t in sums]))
        return pa.Table.from_arrays(_cells(rows), names=CELL_NAMES)

    merged = materialize(dealt.applyInArrow(merge, CELL), "lm-merged")
    higher = merged.filter("sender = -1").withColumn("above", F.pmod(F.xxhash64("grp"), F.lit(above).cast("bigint"))).mapInArrow(onward, CELL)
    answers = materialize(answer_cells(higher, bits, above, fan_bits, tasks, level + 1), "lm-answers")
    coarse = F.shiftrightunsigned("slot", min(max(bits - fan_bits * level, 0) - shift, 63))
    returned = answers.filter("sender >= 0").select(F.col("sender").alias("grp"), coarse.alias("slot"), F.col("slot").alias("fine"), "kind", "size", "counts")
    asked, returned = (d.repartition(tasks, "grp", "slot").groupBy("grp", "slot") for d in (merged.filter("sender >= 0"), returned))
    back = asked.cogroup(returned).applyInArrow(hand_back, CELL)
    return back.unionByName(answers.filter("sender < 0"))


def log_chances(counts: tuple, own: tuple, own_words: np.ndarray, n_words: int, n_distinct: int) -> np.ndarray:
    """Interpolated log-probability of each word after the one before it, from its counts as (word, pair, context) in one model.

    `own` and `own_words` are taken off first: a text is judged by models that have not read it.
    """
    one, two, context = (np.maximum(c - o, 0) for c, o in zip(counts, own))
    unigram = (one + ADDED) / (np.maximum(n_words - own_words, 0) + ADDED * n_distinct)
    bigram = np.where(context > 0, two / np.maximum(context, 1), unigram)
    return np.log(MIXTURE * np.minimum(bigram, 1.0) + (1 - MIXTURE) * unigram)


def cross_entropy_difference(
    docs: DataFrame, target: DataFrame, bits: int = KEY_BITS, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, fan_bits: int = FAN_BITS
) -> DataFrame:
    """id, n_words, target_loss, background_loss and score (their difference per word; lower: more like the target).

    `target` holds ids of target documents. Both models are interpolated bigrams over one vocabulary, all words of the
    corpus, counted over whole texts: the background over all documents, the target over its own. A text's own counts
    are left out where it is scored. Null and empty texts have 0 words and null losses; with an empty target its model
    is uniform. Null ids are scored but never target; repeated rows count and are scored each; other columns are
    ignored. Fewer `bits` than 64 make a hashed vocabulary of 2 ** bits words, whose colliding ones are added up.

    Every distinct word and pair is counted, in Spark tables that grow with the corpus. Texts are put together in
    blocks; a block sends its grams with their counts, and gets the counts over all blocks back (see `answer_cells`): up
    to 2 ** fan_bits blocks in one exchange, the square of that in two, and so on, with a fixed number of cells a block
    in each. Nothing of the corpus is broadcast; the driver gets the number of blocks and three sums. Memory is one block
    of texts, or one text, and the keys of one slot of one group, of about a block's size. Texts are shuffled once as
    they are, and once compressed.
    """
    spark = docs.sparkSession
    workers_see_library(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    with _shuffles_released(spark):
        blocks = materialize(text_blocks(docs, target, id_col, text_col, block_bytes), "lm-texts")
        number = max(1, blocks.count())
        groups, tasks = -(-number >> fan_bits), min(number, 4096 + number // 64)  # a task for each block, of very many for some
        cells = materialize(answer_cells(block_cells(blocks, bits, groups, fan_bits), bits, groups, fan_bits, tasks), "lm-counts")
    sums = cells.filter("sender < 0").agg(*(F.sum(F.when(F.col("sender") == -1 - i, F.col("size"))) for i in range(3))).first()
    n_distinct, n_background, n_target = (int(x or 0) for x in sums)
    n_distinct = n_distinct if bits == KEY_BITS else 1 << bits

    def score(key: tuple, texts: pa.Table, given: pa.Table) -> pa.Table:
        out, given = [], given.sort_by([("slot", "ascending")])
        for payload in texts.column("payload"):
            rows = _texts(payload.as_py())
            block = Block(rows, bits)
            begin = [0, 0]
            for kind, size, counts in zip(*(given.column(c).to_pylist() for c in ("kind", "size", "counts"))):
                for k, packed in enumerate(counts):
                    block.counts[kind][k, begin[kind] : begin[kind] + size] = unpack(packed, size)
                begin[kind] += size
            assert begin == [len(k) for k in block.keys], "an answer is missing"
            own, size = tuple(block.own(k) for k in range(3)), block.n[block.owner]
            zero = tuple(np.zeros_like(x) for x in own)
            background, inside = ((block.counts[0][m][block.at[0]], block.counts[1][m][block.at[1]], block.counts[0][2 + m][block.at[2]]) for m in (0, 1))
            chances = (
                log_chances(inside, own, size, n_target, n_distinct),
                log_chances(inside, zero, 0 * size, n_target, n_distinct),
                log_chances(background, own, size, n_background, n_distinct),
            )
            losses = [np.bincount(block.owner, -c, len(block.n)) / np.maximum(block.n, 1) for c in chances]
            loss = np.where(rows.column("target").to_numpy(zero_copy_only=False), losses[0], losses[1])
            values = [pa.array(x, pa.float64(), mask=block.n == 0) for x in (loss, losses[2], loss - losses[2])]
            out.append(pa.RecordBatch.from_arrays([rows.column("id"), pa.array(block.n.astype(np.int64)), *values], names=NAMES))
        return pa.Table.from_batches(out)

    answers = cells.filter("sender >= 0").select(F.col("sender").alias("block"), "slot", "kind", "size", "counts")
    texts, answers = (d.repartition(tasks, "block").groupBy("block") for d in (blocks.select("block", "payload"), answers))
    scored = texts.cogroup(answers)
    return scored.applyInArrow(score, f"id {id_type}, n_words bigint, target_loss double, background_loss double, score double").withColumnRenamed("id", id_col)
