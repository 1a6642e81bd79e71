"""Words of many texts at once, as arrays of code points."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

# Unicode's main ranges of letters, by script. Other letters are a script of their own.
SCRIPTS = {
    "Latin": [(0x41, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06),
              (0xFF21, 0xFF5A)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Gurmukhi": [(0xA00, 0xA7F)],
    "Gujarati": [(0xA80, 0xAFF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Telugu": [(0xC00, 0xC7F)],
    "Kannada": [(0xC80, 0xCFF)],
    "Malayalam": [(0xD00, 0xD7F)],
    "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "Ethiopic": [(0x1200, 0x139F)],
    "Khmer": [(0x1780, 0x17FF)],
    "Kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
OTHER = len(SCRIPTS) + 1
GROUP_CHARS = 250_000
#: An odd number with evenly spread bits, for polynomial hashes.
BASE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def script_table() -> np.ndarray:
    """Script number of each code point; 0 for what is no letter."""
    table = np.full(0x110000, OTHER, np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            table[a:b + 1] = number
    letter = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)
    table[~letter] = 0
    return table


@dataclass
class Words:
    """The words of a group of texts, one after the other."""

    points: np.ndarray  # lower-case code points of all texts, a line feed after each
    starts: np.ndarray  # of each word, in points
    ends: np.ndarray
    script: np.ndarray  # of each word
    doc: np.ndarray  # of each word: number of its text
    offsets: np.ndarray  # of each text, in points
    letter: np.ndarray  # for each point: whether it is in a word


def lowered(text: str) -> str:
    """Lower case, with as many code points as before."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[0] for c in text)


def words_of(texts: list[str]) -> Words:
    """Runs of letters of one script."""
    joined = "".join(f"{lowered(t)}\n" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    script = script_table()[points]
    edge = np.flatnonzero(script[1:] != script[:-1]) + 1
    starts = np.concatenate([[0], edge])
    ends = np.concatenate([edge, [len(points)]])
    held = script[starts] > 0 if len(points) else np.zeros(1, bool)
    starts, ends = starts[held], ends[held]
    doc = np.searchsorted(offsets, starts, "right") - 1
    return Words(points, starts, ends, script[starts], doc, offsets, script > 0)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits evenly."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """The powers of ``BASE`` from 0 to n, modulo 2**64."""
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, BASE, np.uint64)]))


def groups(texts: list[str], chars: int = GROUP_CHARS) -> Iterator[tuple[int, list[str]]]:
    """The texts in runs of about ``chars`` characters, each with the number of its first."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield first, texts[first:i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]
