import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from placeflow.llm import near_dedup, substring_dedup
from placeflow.llm.tokens import word_hashes


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(rows, k):
    """Smallest reachable id; rows with one id are one document."""
    sets = defaultdict(list)
    for i, t in rows:
        if i is not None:
            sets[i].append(shingles(t, k))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            for a in sets[i]:
                for b in sets[j]:
                    if a and b and 100 * len(a & b) >= 80 * len(a | b):
                        x, y = find(i), find(j)
                        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("k", [4, 5])
def test_links_match_brute_force(docs, rows, k):
    want = brute_components([(r[0], r[1]) for r in rows], k)
    got = near_dedup.link(docs, k).collect()
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((r[0], len(shingles(r[1], k))) for r in rows)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
        assert r.kept == (r.doc_id is None or want[r.doc_id] == r.doc_id)


def test_large_group_of_near_copies_around_one_text(spark):
    """Copies of one text that are too far from each other, with the smallest ids on the copies."""
    r = np.random.default_rng(5)
    base = [f"w{i}" for i in range(200)]
    rows = [(500, " ".join(base))]
    for i in range(150):
        w = list(base)
        for at in r.choice(np.arange(0, 196, 6), 4, replace=False):
            w[at] = f"c{i}_{at}"
        rows.append((i, " ".join(w)))
    rows += [(600 + i, " ".join(base[:60] + [f"x{i}_{j}" for j in range(60)])) for i in range(60)]
    want = brute_components(rows, 4)
    got = near_dedup.link(spark.createDataFrame(rows, "doc_id bigint, text string"), 4).collect()
    assert {x.doc_id: x.component_id for x in got} == want


def test_sketch_estimates():
    r = np.random.default_rng(2)
    pool = r.integers(0, 2**64, 3000, dtype=np.uint64)
    for share in (0.5, 0.8, 0.95):
        n = 1000
        common = int(2 * n * share / (1 + share))
        a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:common], pool[n : 2 * n - common]]))
        est = near_dedup.estimate(near_dedup.sketch(a)[None], near_dedup.sketch(b)[None])[0]
        assert abs(est - share) < 0.12
    one = near_dedup.sketch(pool[:1])
    assert len(set(one.tolist())) == 1
    value = int(pool[0] << np.uint64(8)) >> 8
    zeros = 56 - value.bit_length()
    assert int(one[0]) >> near_dedup.MANTISSA == zeros
    assert int(one[0]) & 1023 == ((value << (zeros + 1)) & (2**56 - 1)) >> 46


def test_repeated_rows_cost_no_comparison(spark, monkeypatch):
    """Two near copies, each row fifty times, and a doc_id with several texts that links two others."""
    base = [f"w{i}" for i in range(60)]
    near, other = " ".join(base[:58] + ["x", "y"]), " ".join(f"v{i}" for i in range(40))
    rows = [(1, " ".join(base))] * 50 + [(2, near)] * 50 + [(3, other)] * 3 + [(9, other), (9, near), (4, other + " end")]
    met = []
    plain = near_dedup.similar
    monkeypatch.setattr(near_dedup, "similar", lambda pairs, k: met.append(pairs.count()) or plain(pairs, k))
    got = near_dedup.link(spark.createDataFrame(rows, "doc_id bigint, text string"), 4).collect()
    assert len(got) == len(rows) and sum(met) <= 4
    want = brute_components(rows, 4)
    assert {(r.doc_id, r.component_id) for r in got} == set(want.items()) and set(want.values()) == {1}


def compared(monkeypatch):
    """Counts the pairs that are compared on full sets."""
    met = []
    plain = near_dedup.similar
    monkeypatch.setattr(near_dedup, "similar", lambda pairs, k: met.append(pairs.count()) or plain(pairs, k))
    return met


def mixed(seed, n, words, common, scattered):
    """Texts of which a share of words is common to all: in one stretch, or scattered."""
    r = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for i in range(n):
        own = r.random(words) >= common if scattered else np.arange(words) >= common * words
        out.append((i, " ".join(f"x{i}_{j}" if o else w for j, (o, w) in enumerate(zip(own, base, strict=True)))))
    return out


@pytest.mark.parametrize(("n", "words", "scattered"), [(120, 3000, False), (120, 3000, True), (120, 600, False)])
def test_long_unlike_texts_of_a_bucket_cost_no_comparison(spark, monkeypatch, n, words, scattered):
    met = compared(monkeypatch)
    got = near_dedup.link(spark.createDataFrame(mixed(1, n, words, 0.84, scattered), "doc_id bigint, text string"), 4).collect()
    assert all(x.component_id == x.doc_id for x in got) and len(got) == n
    assert sum(met) < 1000 and sum(met) <= 2 * n


def test_links_between_long_texts_of_a_bucket(spark, monkeypatch):
    """Pairs of near copies among long texts that share most of their words."""
    rows = mixed(2, 60, 2500, 0.84, False)
    r = np.random.default_rng(3)
    for i, (_, text) in enumerate(rows[:40]):
        w = text.split()
        for at in r.choice(len(w), 20 + 5 * (i % 20), replace=False):
            w[at] = f"y{i}_{at}"
        rows.append((100 + i, " ".join(w)))
    met = compared(monkeypatch)
    want = brute_components(rows, 4)
    got = {x.doc_id: x.component_id for x in near_dedup.link(spark.createDataFrame(rows, "doc_id bigint, text string"), 4).collect()}
    assert got == want and 20 < sum(i != c for i, c in want.items()) <= 40
    assert sum(met) < 1000


def test_rare_shingles_block_all_similar_pairs(spark):
    """Every pair at the similarity or over it shares a block in which it may meet."""
    import zstandard

    r = np.random.default_rng(6)
    pool, press, rows = [f"p{i}" for i in range(80)], zstandard.ZstdCompressor(), []
    for i in range(150):
        if i % 3 and rows:
            w = rows[r.integers(len(rows))].split()
            for at in r.choice(len(w), r.integers(1, 3), replace=False):
                w[at] = str(r.choice(pool))
        else:
            w = [str(x) for x in r.choice(pool, r.integers(20, 90))]
        rows.append(" ".join(w))
    sets = [shingles(t, 4) for t in rows]
    known = spark.createDataFrame([(i, press.compress(t.encode())) for i, t in enumerate(rows)], "doc bigint, blob binary")
    members = spark.createDataFrame([(i, len(s), 7, i) for i, s in enumerate(sets)], "doc bigint, n_shingles bigint, shared bigint, part bigint")
    blocked = near_dedup.blocks(known, members, 4).join(members.select("doc", "part"), "doc")
    met = {(min(p), max(p)) for p in near_dedup.meetings(blocked, 0, None).collect()}
    want = {(i, j) for i in range(150) for j in range(i + 1, 150) if sets[i] != sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert len(want) > 30 and want <= met and len(met) < 1500


def test_bands_miss_few_pairs_at_the_threshold():
    """Registers of a pair at similarity 0.8 agree each by itself with that probability; measured over 400,000 pairs."""
    r, missed = np.random.default_rng(9), 0
    for _ in range(40):
        same = r.random((10_000, near_dedup.REGISTERS)) < 0.8
        missed += int((~same[:, near_dedup._BAND].all(axis=2).any(axis=1)).sum())
    assert missed <= 12


def test_near_dedup_edges(none, docs, clashing):
    assert near_dedup.link(none).count() == 0 and near_dedup.keep(none).count() == 0
    assert near_dedup.keep(clashing).columns == clashing.columns
    assert near_dedup.keep(clashing).count() == near_dedup.keep(docs).count() == near_dedup.link(docs).filter("kept").count()


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 102), (101, 102), (7, 7)]
    got = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert all(got.get(i, i) == 1 for i in range(1, 41)) and got[102] == got.get(101, 100) == 100


def brute_spans(rows, k=13):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = (t or "").encode().split()
        for x in range(len(w) - k + 1):
            first.setdefault(tuple(w[x : x + k]), i)
    out = Counter()
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for x in range(len(w) - k + 1):
            if i is not None and first[tuple(w[x : x + k])] < i:
                gone |= set(range(x, x + k))
        kept = b" ".join(v for n, v in enumerate(w) if n not in gone)
        out[(i, len(w), len(gone), hashlib.sha256(kept).hexdigest())] += 1
    return out


def digests(docs):
    return Counter(map(tuple, substring_dedup.digests(docs).collect()))


def test_spans_match_brute_force(docs, rows):
    assert digests(docs) == brute_spans([(r[0], r[1]) for r in rows])


def test_repeating_words_and_overlapping_owners(spark):
    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    rows = [(5, " ".join(a)), (3, " ".join(a[:20])), (9, " ".join(b[:5] + a[10:35] + b[5:])), (10, " ".join(b)), (11, " ".join(a[14:26] + b[:12])), (2, "z " * 700), (12, "z " * 600 + "y"), (-4, " ".join(b[3:30]))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert digests(df) == brute_spans(rows)
    spans = {r.doc: r.spans for r in substring_dedup.spans(df).collect()}
    assert any((s.start, s.stop, s.owner, s.owner_start) == (5, 30, 5, 10) for s in spans[9])


def test_blocks_meet_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK", 200)
    rows = [(i, " ".join(f"p{j}" for j in range(i % 3, 30)) + f" end{i}") for i in range(30)]
    assert digests(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)) == brute_spans(rows)


def test_windows_of_blocks_are_told_apart_by_their_whole_hashes():
    """Windows with one 64-bit hash and different other bits, shipped in blocks, and copies of one of them."""
    n = 40
    wide, start = np.full(n, 7, np.uint64), np.zeros(n, np.int64)
    more, doc = np.arange(n).astype("<u2") // 2, np.arange(n, dtype=np.int64)[::-1].copy()
    gone, owner, left = substring_dedup.settled(wide, more, doc, start)
    assert sorted(zip(doc[gone], doc[owner], strict=True)) == [(d, d - 1) for d in range(1, n, 2)] and len(left) == n // 2
    cols = [x.astype(k) for x, k in zip((wide, more, doc, start), substring_dedup._RECORD, strict=True)]
    assert all((a == b).all() for a, b in zip(cols, substring_dedup._unpacked(substring_dedup._packed(cols)), strict=True))


def test_colliding_hashes_remove_nothing_wrong(spark, monkeypatch):
    """Every window of a row of ten has the same hash; the owners' words tell them apart."""
    plain = substring_dedup.edges

    def edges(batches, buckets):
        whole = substring_dedup.runs
        substring_dedup.runs = lambda h, k: whole(h, k) % np.uint64(10)
        try:
            yield from plain(batches, buckets)
        finally:
            substring_dedup.runs = whole

    monkeypatch.setattr(substring_dedup, "edges", edges)
    rows = [(i, " ".join(f"a{i}_{j}" for j in range(40))) for i in range(30)]
    got = substring_dedup.digests(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert all(r.n_removed == 0 for r in got) and Counter(map(tuple, got)) == brute_spans(rows)


def test_a_bucket_keeps_one_copy_of_a_window_that_every_block_holds(monkeypatch):
    monkeypatch.setattr(substring_dedup, "GATHERED", 50)
    kind = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    most = []
    plain = substring_dedup.settled

    def settled(wide, *rest):
        most.append(len(wide))
        return plain(wide, *rest)

    text = " ".join(f"p{j}" for j in range(30))
    blocks = [pa.RecordBatch.from_pylist([{"doc_id": i, "text": text}], schema=kind) for i in range(200)]
    packed = list(substring_dedup.edges(iter(blocks), 1))
    monkeypatch.setattr(substring_dedup, "settled", settled)
    out = pa.Table.from_batches(substring_dedup.settle(iter(packed))).to_pylist()
    assert max(most) <= 50 + 2 * 18 and {r["doc"] for r in out} == set(range(1, 200))
    assert sum(r["stop"] - r["start"] for r in out) == 199 * 18 and all(r["owner"] < r["doc"] for r in out)


def test_strip_keeps_columns(none, clashing, docs):
    assert substring_dedup.strip(none).count() == 0
    out = substring_dedup.strip(clashing)
    assert out.columns == clashing.columns and out.count() == docs.count()
    for r in out.filter("text IS NOT NULL AND n_chars IS NOT NULL AND doc_id < 1000").collect():
        assert r.n_chars == len(r.text)


def test_word_hashes_split_at_ascii_blanks_only():
    h, n = word_hashes([b"a\x0bb\x1cc\xc2\xa0d", b"", b" \n"])
    assert n.tolist() == [2, 0, 0] and len(h) == 2
