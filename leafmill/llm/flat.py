"""Texts of a batch as one array of code points."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd


def code_points(text: str) -> np.ndarray:
    """The code points of a text; lone surrogates count as themselves."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def join(texts: list[str], gap: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of all texts with `gap` after each, starts, lengths)."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(lengths + len(gap)) - lengths - len(gap)
    return code_points(gap.join(texts) + gap), starts, lengths


def chunks(items: list, size, limit: int):
    """Slices (start, stop) of `items` whose sizes sum up to about `limit`; a larger item stands alone."""
    start, total = 0, 0
    for i, item in enumerate(items):
        n = size(item)
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if len(items) > start:
        yield start, len(items)


def gram_hash(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """A hash below 2**bits of each n-gram of code points, by its first character."""
    m = max(0, len(codes) - n + 1)
    h = np.zeros(m, np.uint32)
    for i in range(n):
        h *= np.uint32(0x01000193)
        h += codes[i : i + m]
        h ^= h >> np.uint32(13)
    h *= np.uint32(0x9E3779B1)
    return h >> np.uint32(32 - bits)


def filled(work: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A mapInPandas function without the frames of no rows, whose columns have no types to convert by."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return (frame for frame in work(batches) if len(frame))

    return run
