"""Words of many texts as numbers, and hashed character n-grams of many words at once."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, count

import numpy as np

GROUP_WORDS = 100_000
BASE = np.uint64(0x9E3779B97F4A7C15)


def groups(texts: Iterable[str | None], most: int = GROUP_WORDS) -> Iterator[list[list[str]]]:
    """The texts' words, in groups of texts with about `most` words; a longer text is a group of its own."""
    held, size = [], 0
    for text in texts:
        words = text.split() if text else []
        if held and size + len(words) > most:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def numbered(texts: list[list[str]]) -> tuple[np.ndarray, list[str]]:
    """The words of all texts, one after another, as numbers of distinct words, and those words."""
    numbers = defaultdict(count().__next__)
    total = sum(map(len, texts))
    rows = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, total)
    return rows, list(numbers)


def grams(words: list[str], sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each `<word>` and the number of the word each belongs to."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    text = "".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(text, "<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.repeat(np.cumsum(lengths), lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    place, found, owners = np.arange(len(points)), [], []
    rolled, reach = points.copy(), 1
    for size in range(2, max(sizes) + 1):
        rolled = rolled[:-1] * BASE + points[size - 1:] if len(rolled) > 1 else rolled[:0]
        reach = size
        if size in sizes:
            at = place[:len(rolled)][place[:len(rolled)] + reach <= ends[:len(rolled)]]
            mixed = (rolled[at] + np.uint64(size)) * BASE
            found.append(((mixed ^ (mixed >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64))
            owners.append(owner[at])
    return np.concatenate(found), np.concatenate(owners)
