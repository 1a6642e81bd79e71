"""Word shingles of many texts at once, as arrays of 64-bit numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tallyhouse.llm.letters import BASE, groups, mixed, powers

# Fixed value: the bytes between words (space and the controls 9 to 13).
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of the texts, A-Z in lower case, and the number of its text."""
    # bytes.lower() changes A-Z alone.
    data = [t.encode().lower() for t in texts]
    points = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    offsets = np.cumsum([len(d) + 1 for d in data])
    held = ~_SPACE[points]
    edge = np.flatnonzero(np.diff(held, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = ends - starts
    power = powers(int(lengths.max()))
    begin = np.cumsum(lengths) - lengths
    value = (points[held].astype(np.uint64) + np.uint64(1)) * power[np.arange(int(lengths.sum())) - np.repeat(begin, lengths)]
    return mixed(np.add.reduceat(value, begin) + lengths.astype(np.uint64)), np.searchsorted(offsets, starts, "right")


def shingle_sets(texts: list[str], width: int) -> Iterator[np.ndarray]:
    """The sorted set of each text's shingles of ``width`` words.

    A text with fewer words has its whole sequence as the only one, a text without words none. Equal
    numbers stand for equal shingles (64 bits each; within two texts of a million words, the odds of
    a chance hit are below one in ten million).
    """
    for _, group in groups(texts):
        words, doc = word_numbers(group)
        bounds = np.searchsorted(doc, np.arange(len(group) + 1))
        run = np.zeros(max(len(words) - width + 1, 0), np.uint64)
        for k in range(width if len(run) else 0):
            run = run * BASE + words[k:len(words) - width + 1 + k]
        run = mixed(run)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= width:
                yield np.unique(run[a:b - width + 1].view(np.int64))
            elif b > a:
                whole = np.uint64(b - a)
                for w in words[a:b]:
                    with np.errstate(over="ignore"):
                        whole = whole * BASE + w
                yield mixed(np.array([whole])).view(np.int64)
            else:
                yield np.zeros(0, np.int64)
