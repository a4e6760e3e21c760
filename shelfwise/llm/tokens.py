"""Operator 3, token counts, and the ids of byte-level vocabularies that packing needs."""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from shelfwise.llm.common import slices, workers_see_library

# White space of Unicode, as the library's patterns see it.
WHITE = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# Fixed value: the split of byte-level vocabularies.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

KEEP_WORDS, KEEP_LENGTH = 250_000, 64  # words in each of two generations of a worker's memory; others are worked out again


def plain_spaces(pattern: str) -> str:
    r"""The pattern with \s and \S written out, as Python's own sets differ from the library's by a few control signs."""
    return pattern.replace(r"[^\s", "[^" + WHITE).replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]")


def byte_signs() -> list[str]:
    """The printable sign for each byte: itself where printable, else the next free one from 256 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(free)) for b in range(256)]


class Memory(dict):
    """Answers of `work` for short words. When full, it becomes the old generation, of which used words are taken over."""

    def __init__(self, work):
        super().__init__()
        self.work, self.old = work, {}

    def __missing__(self, word):
        answer = self.old.get(word)
        if answer is None:
            answer = self.work(word)
        if len(word) <= KEEP_LENGTH:
            if len(self) >= KEEP_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = answer
        return answer


def merge_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges the symbols allow: the lowest-ranked neighbours first, the leftmost of equals.

    Live symbols are a doubly linked list; the heap holds (rank, place, left, right), and an entry whose
    symbols have changed since is stale.
    """
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[pair], i, *pair) for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in ranks]
    heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue
        symbols[i], symbols[j] = left + right, ""
        k = after[i] = after[j]
        merges += 1
        if k < n:
            before[k] = i
            if (rank := ranks.get((symbols[i], symbols[k]))) is not None:
                heappush(heap, (rank, i, symbols[i], symbols[k]))
        if (h := before[i]) >= 0 and (rank := ranks.get((symbols[h], symbols[i]))) is not None:
            heappush(heap, (rank, h, symbols[h], symbols[i]))
    return merges


class TokenCounter:
    """Counts tokens as a tokenizers file of the byte-pair kind defines them; no identifiers are made."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("dropout"):
            raise ValueError("only plain byte-pair vocabularies are counted")
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ranks = {pair: i for i, pair in enumerate(pairs)}
        self.signs = byte_signs()
        steps = spec["normalizer"] or {}
        self.steps = [s for s in steps.get("normalizers", [steps]) if s]
        pre = spec["pre_tokenizer"]
        split = [p for p in pre.get("pretokenizers", [pre]) if p["type"] == "Split"]
        self.split = regex.compile(plain_spaces(split[0]["pattern"]["Regex"] if split else BYTE_LEVEL_SPLIT))
        special = sorted((a["content"] for a in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.replace = {s["pattern"]["Regex"]: regex.compile(plain_spaces(s["pattern"]["Regex"])) for s in self.steps if s["type"] == "Replace"}
        if not self.split.search(WHITE):  # no word holds white space, so how much of it stands between words is all the same
            self.steps = [s for s in self.steps if s.get("pattern", {}).get("Regex") != r"\s+" or s["content"] != " "]
        self.counts = Memory(self.of_word)

    def of_word(self, word: str) -> int:
        symbols = [self.signs[b] for b in word.encode()]
        symbols[-1] += self.suffix
        return len(symbols) - merge_count(symbols, self.ranks)

    def normal(self, text: str) -> str:
        for step in self.steps:
            if step["type"] == "NFC":
                text = text if text.isascii() else unicodedata.normalize("NFC", text)
            elif step["type"] == "Replace":
                text = self.replace[step["pattern"]["Regex"]].sub(step["content"], text)
            elif step["type"] == "Lowercase":
                text = text.replace("Σ", "σ").lower()  # sign by sign: no final sigma
            else:
                raise ValueError(f"normalizer {step['type']} is not known")
        return text

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        total, parts = 0, [text]
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            total = len(parts) - 1
        for part in parts:
            total += sum(map(self.counts.__getitem__, self.split.findall(self.normal(part))))
        return total


_made: dict = {}


def made_once(kind, spec: str):
    """A worker makes each counter or encoder once."""
    key = (kind.__name__, len(spec), hash(spec))
    if key not in _made:
        _made[key] = kind(spec)
    return _made[key]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text, by merging with a heap and a linked list.

    `vocabulary` is a tokenizers .json file the driver can read; its content (a few MB, whatever the corpus) goes
    to the workers. Null and empty texts have 0 bytes and 0 tokens. A null id stays null; repeated rows are counted
    each; other columns are ignored, whatever their names. Memory: one text and a bounded store of words. No shuffle.
    """
    spark = docs.sparkSession
    workers_see_library(spark)
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = made_once(TokenCounter, spec.value)
        for part in slices(batches):
            texts = part.column("text")
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            n_tokens = np.fromiter((counter.count(t.as_py()) for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), n_bytes, pa.array(n_tokens), pa.array(n_tokens > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")


#: Signs whose class no Unicode version has changed; texts with others are left to the library.
_STEADY = regex.compile("[\t\n\v\f\r\x20-\x7e\xa0-" + chr(0x36F) + chr(0x400) + "-" + chr(0x45F) + chr(0x2010) + "-" + chr(0x2027) + "]*")


class ByteLevelEncoder:
    """Ids of a byte-level vocabulary of the tokenizers kind.

    Where ids follow the order of merges and no normalizer is set, a faster public implementation of the same merges
    makes them (tests compare both); anything else goes through the library.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        parsed = json.loads(spec)
        self.library = Tokenizer.from_str(spec)
        self.special = {a["content"]: a["id"] for a in parsed["added_tokens"]}
        self.any_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.fast = self._fast(parsed)

    def _fast(self, parsed: dict):
        pre, model, signs = parsed["pre_tokenizer"], parsed["model"], byte_signs()
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        plain = pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not parsed["normalizer"] and not model.get("ignore_merges")
        if not plain or len(vocab) != 256 + len(pairs) or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
            return None
        import tiktoken

        of_sign = {sign: b for b, sign in enumerate(signs)}
        ranks = {bytes(of_sign[c] for c in token): i for token, i in vocab.items()}
        return tiktoken.Encoding("byte_level", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.fast is None or not _STEADY.fullmatch(text):
            return self.library.encode(text, add_special_tokens=False).ids
        if self.any_special is None or not self.any_special.search(text):
            return self.fast(text)
        ids = []
        for part in self.any_special.split(text):
            ids += [self.special[part]] if part in self.special else self.fast(part)
        return ids
