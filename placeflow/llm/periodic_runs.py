"""Operator 11: periodic runs of words, found by probing harmonic grids.

A run is a stretch of consecutive words with smallest period q that is at least
`LEAST` words and `TIMES` periods long and that no neighbouring word extends. A
stretch of four periods p holds four points of the grid 0, p, 2p, ..., so for
every p only the words at jp and (j+1)p are compared; three equal neighbours in
a row survive. A survivor is extended to both sides by comparing chunks of the
array with itself, p words on, each chunk twice as long as the one before.

Grid points within found runs are skipped. If the words at jp and (j+1)p both
lie in a run of four periods p or more whose own period divides p, their stretch
is that run. Any other survivor's stretch, if it is long enough, has p as its
smallest period: a smaller one would divide p (the stretch is longer than both
together), so the run of that period would be the same stretch, found before,
and hold the pair. All periods together cost n/1 + n/2 + n/3 + ... probes of a
text of n words.

Words are compared as numbers of their bytes in a dictionary, so equality is
exact. Texts of a batch lie in one array, the longest first, with a number
between neighbours that occurs once; grids run over the array as a whole.

A null text, an empty one and one of blanks have no words: no runs, four nulls
and the digests of the empty text. `sample` (as the query applies it) makes the
words of some documents periodic; a null doc_id counts as the empty text there.
Rows are judged alone, so repeated rows get the same result. Ties for the
longest run go to the smallest start, then period. An empty table gives no
rows; extra columns are ignored. A very long text is one row of a batch, with
some 80 bytes for each of its words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from placeflow.llm.common import chunks, columns, raw, table
from placeflow.llm.tokens import coded_words

#: Shortest run in words, and in periods. The grid needs at least four periods.
LEAST, TIMES = 6, 4
#: Words of the first chunk when a survivor is extended.
CHUNK = 32

KIND = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def _reach(w: np.ndarray, at: int, p: int, step: int, end: int) -> int:
    """How many words from `at` on, in the direction of step (1 or -1) and short of `end`, equal those p further right."""
    n, size = 0, CHUNK
    while (left := abs(end - at) - n) > 0:
        size = min(size, left)
        a = at + n if step > 0 else at - n - size + 1
        differ = np.flatnonzero(w[a : a + size] != w[a + p : a + p + size])
        if len(differ):
            return n + int(differ[0] if step > 0 else size - 1 - differ[-1])
        n += size
        size *= 2
    return n


def find(w: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) of texts that lie one after another in w, the longest first, each followed by a number that occurs once."""
    ends = np.cumsum(counts + 1)
    found: list[tuple[int, int, int]] = []
    wide: list[tuple[int, int, int]] = []  # of those, the ones long enough for the period at hand
    alive = len(counts)
    p = 0
    while True:
        p += 1
        need = max(LEAST, TIMES * p)
        while alive and counts[alive - 1] < need:
            alive -= 1
        if not alive:
            return sorted(found)
        stop = int(ends[alive - 1])
        grid = w[:stop:p]
        same = grid[1:] == grid[:-1]
        hits = np.flatnonzero(same[2:] & same[1:-1] & same[:-2])
        if not len(hits):
            continue
        hits *= p
        skip = np.zeros(len(hits), dtype=bool)
        wide = [r for r in wide if r[1] - r[0] >= need]
        for a, b, q in wide:
            if p % q == 0:
                lo, hi = np.searchsorted(hits, (a, b - p))
                skip[lo:hi] = True
        last = -1
        for x in hits[~skip].tolist():
            if x < last:  # its pair lies in the stretch before
                continue
            b = x + _reach(w, x, p, 1, stop - p) + p
            a = x - _reach(w, x - 1, p, -1, -1)
            last = b - p
            if b - a >= need:
                found.append((a, b, p))
                wide.append((a, b, p))


def made_periodic(w: np.ndarray, h: int) -> np.ndarray:
    """Word numbers of a document with the hash h: every tenth hash repeats a piece of the text to its end."""
    n = len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([w[:a], w[a + np.arange(n - a) % p]])


def results(texts: list[bytes], ids: list[int | None], sample: bool = False) -> Iterator[tuple]:
    """n_runs, the longest run and the digests of each text, in order; with `sample`, of the words that made_periodic gives."""
    words, codes, counts, _, _ = coded_words(texts)
    words = words.to_pylist()
    firsts = (np.cumsum(counts) - counts).tolist()
    codes = codes.astype(np.int32)
    parts = [codes[f : f + n] for f, n in zip(firsts, counts.tolist(), strict=True)]
    if sample:
        parts = [made_periodic(w, zlib.crc32(b"" if i is None else str(i).encode())) for w, i in zip(parts, ids, strict=True)]
    order = np.argsort(-counts, kind="stable")
    sizes = counts[order]
    row = np.empty(int((counts + 1).sum()), dtype=np.int32)
    begin = np.cumsum(sizes + 1) - sizes - 1
    for k, (at, i) in enumerate(zip(begin.tolist(), order.tolist(), strict=True)):
        row[at : at + len(parts[i])] = parts[i]
        row[at + len(parts[i])] = -1 - k
    runs: dict[int, list[tuple[int, int, int]]] = {}
    for a, b, p in find(row, sizes):
        k = int(np.searchsorted(begin, a, side="right")) - 1
        runs.setdefault(int(order[k]), []).append((a - int(begin[k]), b - a, p))
    for i, w in enumerate(parts):
        own = sorted(runs.get(i, []), key=itemgetter(0, 2))
        keep = w
        if own:
            edge = np.zeros(len(w) + 1, dtype=np.int32)
            for a, n, p in own:
                edge[a + p] += 1
                edge[a + n] -= 1
            keep = w[np.cumsum(edge[:-1]) == 0]
        a, n, p = min(own, key=lambda r: (-r[1], r[0], r[2])) if own else (None, None, None)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in own)
        collapsed = b" ".join(map(words.__getitem__, keep.tolist()))
        yield len(own), a, n, p, None if n is None else 1000 * n // p, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest()


def detect(docs: DataFrame, sample: bool = False) -> DataFrame:
    """doc_id, n_runs, the longest run and the two digests of every document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=2_000_000):
            texts = [t or b"" for t in raw(batch.column("text"))]
            rows = list(results(texts, batch.column("doc_id").to_pylist(), sample))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    return columns(docs, "doc_id", "text").mapInArrow(task, KIND)


def op11_harmonic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents"), sample=True)
