"""Word hashes of many texts at once, for the operators on shingles and windows."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
#: Distinct words whose hash a worker keeps.
MEMO = 200_000


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * _M1
        x = (x ^ (x >> np.uint64(33))) * _M2
        return x ^ (x >> np.uint64(33))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_KNOWN = _Hashes()


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the texts' words in a row, and the number of words of each text.

    Each distinct word is hashed once in a worker process, which forgets all
    of them beyond MEMO.
    """
    if len(_KNOWN) > MEMO:
        _KNOWN.clear()
    split = [t.split() for t in texts]  # bytes split at the six ASCII blanks
    counts = np.fromiter(map(len, split), np.int64, len(split))
    return np.fromiter(map(_KNOWN.__getitem__, chain.from_iterable(split)), np.uint64, int(counts.sum())), counts


_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(b" \t\n\x0b\x0c\r")] = True
#: Blank, letter, digit, other: classes of single ASCII bytes.
_CLASS = np.full(256, 3, dtype=np.uint8)
_CLASS[_BLANK] = 0
_CLASS[[*range(65, 91), *range(97, 123)]] = 1
_CLASS[48:58] = 2


def coded_words(texts: list[bytes], parts: bool = False) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of the texts, the code of each word in a row, of each text its words and those of its prompt, and which words are whole.

    A text's prompt is its first line that has a word, if words follow it. With
    `parts`, words of ASCII and Latin-1 letters are cut into runs of letters
    (made lower case), single digits and runs of other marks; words with an
    apostrophe or any other character stay whole, as they are.
    """
    if not texts:
        return pa.array([], pa.large_binary()), *[np.empty(0, np.int64)] * 3, np.empty(0, bool)
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind = np.where(_BLANK[buf], 0, 4).astype(np.uint8)
    low = buf
    if parts:
        edge = np.flatnonzero(np.diff(kind, prepend=0))
        start, stop = edge[::2], edge[1::2]
        lead = buf == 0xC3  # Latin-1 letters are this byte and a second one
        second = np.append(False, lead[:-1]) & (buf >= 0x80) & (buf != 0x97) & (buf != 0xB7)
        odd = np.flatnonzero(((buf >= 0x80) & ~lead & ~second) | (buf == 39))
        kind = _CLASS[buf]
        kind[lead | second] = 1
        low = np.where((buf >= 65) & (buf <= 90) | second & (buf <= 0x9E), buf + np.uint8(32), buf)
        whole = np.zeros(len(buf) + 1, np.int8)
        words = np.unique(np.searchsorted(start, odd, side="right") - 1)
        whole[start[words]] += 1
        whole[stop[words]] -= 1
        whole = np.cumsum(whole[:-1]) > 0
        kind[whole], low[whole] = 4, buf[whole]
    cut = np.ones(len(kind) + 1, dtype=bool)
    cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    start, stop = np.flatnonzero(cut[:-1] & (kind > 0)), np.flatnonzero(cut[1:] & (kind > 0)) + 1
    ends = np.append(0, np.cumsum(stop - start))
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(low[kind > 0])]).dictionary_encode()
    codes = words.indices.to_numpy().astype(np.int64)
    bounds = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    upto = np.searchsorted(start, bounds)
    counts = np.diff(upto, prepend=0)
    prompts = np.zeros(len(texts), np.int64)
    full = np.flatnonzero(counts)
    lines = np.flatnonzero(buf == 10)
    line = lines[np.searchsorted(lines, start[upto[full] - counts[full]])]
    prompts[full] = np.searchsorted(start, line) - (upto - counts)[full]
    prompts[prompts == counts] = 0
    whole = np.zeros(len(words.dictionary), dtype=bool)
    whole[codes[kind[start] == 4]] = True
    return words.dictionary, codes, counts, prompts, whole


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k neighbouring entries, over the whole row (runs across texts included)."""
    if len(h) < k:
        return np.empty(0, dtype=np.uint64)
    n = len(h) - k + 1
    with np.errstate(over="ignore"):
        out = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            out = (out * np.uint64(0x9E3779B97F4A7C15)) + h[j : j + n]
    return mix(out)


def starts_of(counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (in the whole row) where a run of k lies within one text, and the texts they lie in."""
    first = np.cumsum(counts) - counts
    per = np.maximum(counts - k + 1, 0)
    owner = np.repeat(np.arange(len(counts)), per)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    return first[owner] + inside, owner
