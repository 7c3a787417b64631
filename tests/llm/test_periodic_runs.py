import hashlib
import random
import zlib

import numpy as np

from placeflow.llm import periodic_runs


def brute_runs(ws):
    """All runs by definition: every period, every stretch, smallest period by trying all."""
    out = set()
    for p in range(1, len(ws) // 4 + 1):
        i = 0
        while i < len(ws) - p:
            j = i
            while j < len(ws) - p and ws[j] == ws[j + p]:
                j += 1
            n = j + p - i
            if j > i and n >= max(6, 4 * p) and not any(all(ws[x] == ws[x + q] for x in range(i, j + p - q)) for q in range(1, p)):
                out.add((i, n, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text, sample=True):
    ws = (text or "").encode().split()
    n, h = len(ws), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if sample and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(ws)
    gone = {x for s, m, p in runs for x in range(s + p, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()
    kept = b" ".join(w for i, w in enumerate(ws) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def periodic_rows(n=1500, seed=3):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        letters = ("ab", "abcdefgh", "a")[k % 3]
        ws = [r.choice(letters) for _ in range(r.choice([0, 1, 5, 6, 7, 12, 30, 70]))]
        if k % 4 == 0 and len(ws) > 5:
            at = r.randrange(len(ws))
            ws[at:at] = ([r.choice(letters) for _ in range(r.randint(1, 6))] * 9)[: r.randint(6, 50)]
            if k % 8 == 0:
                ws = ws * r.randint(1, 5)
        rows.append((k, r.choice([" ", "\n", " \t "]).join(ws)))
    return rows


def key(rows):
    return sorted(rows, key=str)


def test_runs_match_brute_force(spark):
    rows = periodic_rows()
    want = [brute(*r) for r in rows]
    assert sum(r[1] for r in want) > 500 and any(r[1] > 2 for r in want)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert key(tuple(r) for r in periodic_runs.detect(df, sample=True).collect()) == key(want)
    assert key(tuple(r) for r in periodic_runs.detect(df).collect()) == key(brute(*r, sample=False) for r in rows)


def test_odd_rows(docs, rows, none, clashing):
    """Nulls, empty texts, repeated rows, a null id, extra columns, an empty table."""
    short = [r for r in rows if len((r[1] or "").split()) < 500]
    want = key(brute(r[0], r[1]) for r in short)
    got = periodic_runs.detect(clashing, sample=True).collect()
    assert len(got) == len(rows)
    assert key(tuple(r) for r in got if r.doc_id != 1005) == want
    (words,) = [r for r in got if r.doc_id == 1005]
    assert (words.n_runs, words.start, words.period) == (1, 0, 1) and words.length == 9000
    blank = [r for r in got if r.doc_id in (1001, 1002, 1003)]
    assert len(blank) == 3 and all(r[1:6] == (0, None, None, None, None) and r.runs_sha256 == r.collapsed_sha256 == hashlib.sha256(b"").hexdigest() for r in blank)
    assert periodic_runs.detect(none).collect() == [] and periodic_runs.detect(none).columns == periodic_runs.detect(docs).columns


def test_very_long_texts():
    """Half a million words: all alike, without a run, with one run of a long period, and of two letters."""
    r = random.Random(5)
    n = 500_000
    alike, odd = b"a " * n, " ".join(map(str, range(n))).encode()
    piece = [str(r.randrange(10**6)) for _ in range(40_000)]
    long = " ".join([*map(str, range(10**6, 10**6 + 77)), *(piece * 5)[: 4 * 40_000 + 123], "end"]).encode()
    two = " ".join(r.choice("ab") for _ in range(100_000))
    got = list(periodic_runs.results([alike, b"", odd, long, two.encode()], [1, 2, 3, 4, 5]))
    assert got[0][:5] == (1, 0, n, 1, 1000 * n) and got[1][0] == got[2][0] == 0
    assert got[3][:5] == (1, 77, 160_123, 40_000, 4003)
    assert got[4][0] > 1000
    lone = list(periodic_runs.results([two.encode()], [5]))
    assert lone[0] == got[4]
    assert list(periodic_runs.results([b"x" * 5_000_000, b"\n" * 5_000_000], [1, 2]))[0][0] == 0


def test_reach_compares_chunks_of_any_size(monkeypatch):
    w = np.array([9] + [1, 2, 3] * 50 + [7] + [-1], dtype=np.int32)
    for chunk in (1, 2, 5, 64, 1000):
        monkeypatch.setattr(periodic_runs, "CHUNK", chunk)
        assert periodic_runs.find(w, np.array([len(w) - 1])) == [(1, 151, 3)]
