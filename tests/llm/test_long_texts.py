"""Texts of five megabytes: many different words, one word without a blank, line ends only; and a copy of the first one with a few changes."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from placeflow.llm import class_lm, near_dedup, packing, quality_rules, sharding, substring_dedup

MEGABYTES = 5


@pytest.fixture(scope="module")
def texts():
    r = np.random.default_rng(1)
    words = [f"w{x}" for x in r.integers(0, 10**6, MEGABYTES * 1_000_000 // 8)]
    changed = list(words)
    for at in r.choice(len(words), 200, replace=False):
        changed[at] = f"c{at}"
    return {1: " ".join(words), 2: "xyz" * (MEGABYTES * 333_333), 3: "\n" * (MEGABYTES * 1_000_000), 4: " ".join(changed), 5: "a short text of a few words that is there as well, twice over"}


@pytest.fixture(scope="module")
def long(spark, texts):
    kind = "doc_id bigint, text string, source string, lang string, n_chars bigint"
    return spark.createDataFrame([(i, t, "h", "en", len(t)) for i, t in texts.items()], kind).repartition(5).checkpoint()


def test_rules(long, texts):
    got = {r.doc_id: r for r in quality_rules.judge(long).collect()}
    for i, t in texts.items():
        ws = t.split()
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == (len(ws), sum(map(len, ws)), 0, 0, 0)


def test_shards(long, texts):
    got = {r.doc_id: r for r in sharding.shard(long).collect()}
    assert {i: (r["size"], r.text_crc32) for i, r in got.items()} == {i: (len(t) + 1, zlib.crc32(t.encode())) for i, t in texts.items()}
    assert len({r.shard for r in got.values()}) == 5


def test_packing(long, texts):
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    t = Tokenizer.from_file(path)
    pieces = {}
    for r in packing.pack(long, path).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    for i in (1, 3, 5):
        ids = np.array([*t.encode(texts[i], add_special_tokens=False).ids, 1], "<u4")
        assert sum(r.length for r in pieces[i]) == len(ids) == pieces[i][0].doc_tokens
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in pieces[i])
    assert sum(r.length for r in pieces[2]) == pieces[2][0].doc_tokens > 1


def test_class_model(long, texts):
    model, counts = class_lm.fit(long)
    got = {r.doc_id: r for r in class_lm.scored(long, model, counts).collect()}
    c = Counter(w for t in texts.values() for w in [*t.encode().lower().split(), b""])
    n, v = sum(c.values()), len(c)
    for i, t in texts.items():
        ws = [*t.encode().lower().split(), b""]
        base = sum(np.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        assert (got[i].n_tokens, got[i].n_known) == (len(ws), len(ws)) and abs(got[i].base_score - base) < 1e-6 * abs(base) + 1e-9


def test_near_copies(long, texts):
    got = {r.doc_id: r for r in near_dedup.link(long, 4).collect()}
    assert {i: r.component_id for i, r in got.items()} == {1: 1, 2: 2, 3: 3, 4: 1, 5: 5}
    ws = texts[1].split()
    assert got[1].n_shingles == len({tuple(ws[i : i + 4]) for i in range(len(ws) - 3)}) and got[2].n_shingles == 1 and got[3].n_shingles == 0


def test_repeated_spans(long, texts):
    got = {r.doc_id: r for r in substring_dedup.digests(long).collect()}
    first, second = texts[1].split(), texts[4].split()
    windows = {tuple(first[i : i + 13]) for i in range(len(first) - 12)}
    edge = np.zeros(len(second) + 1, np.int64)
    for i in range(len(second) - 12):
        if tuple(second[i : i + 13]) in windows:
            edge[i] += 1
            edge[i + 13] -= 1
    kept = [w for w, c in zip(second, np.cumsum(edge), strict=False) if not c]
    assert 0 < len(kept) < len(second) // 50
    assert (got[4].n_removed, got[4].kept_sha256) == (len(second) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    assert [got[i].n_removed for i in (1, 2, 3, 5)] == [0] * 4 and got[1].kept_sha256 == hashlib.sha256(texts[1].encode()).hexdigest()
