"""Problem 8: encoding a corpus with a public byte-level BPE vocabulary.

A text is split into words by the vocabulary's pattern; the words of many texts that are not yet in
the worker's cache are merged together: their symbols lie in one flat array, every round finds the
rank of each neighbouring pair by binary search over the sorted pair keys and merges, in every word
at once, the pair of lowest rank.  Words longer than LONG_WORD symbols, which would need very many
rounds, are merged one by one with a heap; both give the same ids.
"""

from __future__ import annotations

import functools
import heapq
import json
import os
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.session import spread

#: Where the vocabulary files lie; a parameter of every operator here, never copied into the repository.
TOKENIZER_DIR = os.environ.get("LEAFMILL_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.json"
#: Symbols of a word beyond which it is merged alone.
LONG_WORD = 400
#: Characters of text that are split at once, and words a worker keeps; they bound a worker's memory.
CHUNK_CHARS = 1 << 20
CACHE_WORDS = 1 << 17

#: Unicode's White_Space, which the vocabulary's pattern means by \s.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The endings that the pattern splits off.
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"


def _ranges(codes: list[int]) -> str:
    """A character class's content for sorted code points."""
    parts, start, last = [], None, None
    for c in [*codes, None]:
        if start is not None and (c is None or c != last + 1):
            parts.append(f"\\U{start:08x}-\\U{last:08x}")
            start = None
        if start is None:
            start = c
        last = c
    return "".join(parts)


@functools.cache
def word_pattern() -> re.Pattern:
    """The vocabulary's pattern for the standard library's re, in which \\w is letters, numbers and _."""
    other_numbers = _ranges([c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Nl", "No")])
    letter, number, mark = f"[^\\W\\d_{other_numbers}]", f"[\\d{other_numbers}]", f"(?:[^\\w{SPACE}]|_)"
    return re.compile(f"{ENDINGS}| ?{letter}+| ?{number}+| ?{mark}+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


class Vocabulary:
    """Ids of single bytes and, sorted by pair key, the rank and the id of every merge."""

    SHIFT = 20

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids = model["vocab"]
        # printable bytes stand for themselves, the others for the code points from 256 on
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(kept)]
        sign = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.byte_id = np.array([ids[sign[b]] for b in range(256)], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([(ids[a] << self.SHIFT) | ids[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.rank = order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)[order]
        self.none = np.int64(len(keys))
        self.pair = {int(k): (int(r), int(m)) for k, r, m in zip(self.keys, self.rank, self.merged)}

    def merge_rounds(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, length of each word) of non-empty words."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        out_symbols, out_word = [], []
        while len(symbols):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            key = (symbols[:-1] << self.SHIFT) | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.append(np.where(hit, self.rank[at], self.none), self.none)
            counts = np.diff(np.append(starts, len(symbols)))
            best = np.repeat(np.minimum.reduceat(rank, starts), counts)
            finished = best == self.none
            first = np.flatnonzero((rank == best) & ~finished)
            if len(first):
                # of overlapping occurrences (aaa with the pair aa) every second one, from the left
                run_start = np.flatnonzero(np.diff(first, prepend=-2) != 1)
                place = np.arange(len(first)) - np.repeat(run_start, np.diff(np.append(run_start, len(first))))
                first = first[place % 2 == 0]
                symbols[first] = self.merged[at[first]]
            if finished.any():
                out_symbols.append(symbols[finished])
                out_word.append(word[finished])
            keep = ~finished
            keep[first + 1] = False
            symbols, word = symbols[keep], word[keep]
        flat, owner = np.concatenate(out_symbols), np.concatenate(out_word)
        flat = flat[np.argsort(owner, kind="stable")]
        return flat, np.bincount(owner, minlength=len(words))

    def merge_long(self, word: bytes) -> np.ndarray:
        """The ids of one long word: a linked list of symbols and a heap of its pairs."""
        symbols = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, len(symbols)), -1], [-1, *range(len(symbols) - 1)]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and (found := self.pair.get((symbols[i] << self.SHIFT) | symbols[j])):
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(len(symbols) - 1):
            offer(i)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            symbols[i], symbols[j], after[i] = merged, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return np.array([s for s in symbols if s >= 0], dtype=np.int64)


class Encoder:
    """Encodes lists of texts; keeps the ids of words seen, up to CACHE_WORDS."""

    def __init__(self, directory: str = TOKENIZER_DIR, name: str = VOCABULARY):
        self.vocabulary = Vocabulary(os.path.join(directory, name))
        self.findall = word_pattern().findall
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.start, self.length = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        raw = [w.encode("utf-8", "replace") for w in words]
        short = [i for i, b in enumerate(raw) if len(b) <= LONG_WORD]
        ids: list[np.ndarray | None] = [None] * len(raw)
        if short:
            flat, lengths = self.vocabulary.merge_rounds([raw[i] for i in short])
            for i, part in zip(short, np.split(flat, np.cumsum(lengths)[:-1])):
                ids[i] = part
        for i, part in enumerate(ids):
            if part is None:
                ids[i] = self.vocabulary.merge_long(raw[i])
        base = len(self.place)
        self.place.update(zip(words, range(base, base + len(words))))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        self.start = np.append(self.start, len(self.flat) + np.cumsum(lengths) - lengths)
        self.length = np.append(self.length, lengths)
        self.flat = np.concatenate([self.flat, *ids]).astype(np.int32)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids of each text); null and empty texts have none."""
        flats, counts = [], []
        chunk: list[str] = []
        size = 0
        for text in texts:
            chunk.append(text or "")
            size += len(chunk[-1])
            if size >= CHUNK_CHARS:
                self._chunk(chunk, flats, counts)
                chunk, size = [], 0
        if chunk:
            self._chunk(chunk, flats, counts)
        none = np.empty(0, np.int32)
        return np.concatenate(flats or [none]), np.concatenate(counts or [none]).astype(np.int64)

    def _chunk(self, texts: list[str], flats: list, counts: list) -> None:
        words: list[str] = []
        ends = []
        for text in texts:
            words += self.findall(text)
            ends.append(len(words))
        if len(self.place) > CACHE_WORDS:
            self._forget()
        new = set(words).difference(self.place)
        if new:
            self._learn(sorted(new))
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        lengths = self.length[at]
        total = np.append(0, np.cumsum(lengths))
        flats.append(self.flat[np.repeat(self.start[at] - total[:-1], lengths) + np.arange(total[-1])])
        counts.append(np.diff(total[ends], prepend=0))


def _encoded(batches: Iterator[pa.RecordBatch], directory: str, name: str, lists: bool) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(directory, name)
    for batch in batches:
        flat, counts = encoder.encode(batch.column(1).to_pylist())
        if lists:
            offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
            value = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
        else:
            value = pa.array(counts, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), value], ["_key", "_value"])


def token_ids(
    df: DataFrame, key: str = "doc_id", text: str = "text", directory: str = TOKENIZER_DIR, name: str = VOCABULARY
) -> DataFrame:
    """(key, ids): the ids of each row's text, without special tokens; no shuffle.

    Null and empty texts give an empty list, never null; a blank text has ids like any other.  Repeated
    rows give repeated rows, a null key stays null, extra columns are not read."""
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    done = spread(rows).mapInArrow(lambda it: _encoded(it, directory, name, True), f"_key {kind}, _value array<int>")
    return done.select(F.col("_key").alias(key), F.col("_value").alias("ids"))


def token_counts(
    df: DataFrame, key: str = "doc_id", text: str = "text", directory: str = TOKENIZER_DIR, name: str = VOCABULARY
) -> DataFrame:
    """(key, tokens): the number of ids of each row's text, 0 for null and empty texts."""
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    done = spread(rows).mapInArrow(lambda it: _encoded(it, directory, name, False), f"_key {kind}, _value bigint")
    return done.select(F.col("_key").alias(key), F.col("_value").alias("tokens"))


def p8_ids(spark, sf_dir: str) -> DataFrame:
    return token_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"p8_ids": p8_ids}
SQL: dict[str, str] = {}
