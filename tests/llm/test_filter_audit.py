from collections import Counter
from itertools import permutations

import pytest

from placeflow.llm import filter_audit

KIND = "doc_id bigint, text string, source string"


def brute(rows, labels):
    """Every order applied filter by filter to every document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    texts = {}
    for i, t, *_ in rows:
        if i is not None:
            texts[t or ""] = min(i, texts.get(t or "", i))
    docs = []
    for i, t, source in rows:
        t = t or ""
        ws = t.encode().split()
        fails = set()
        fails |= {"A"} if len(ws) < 200 else set()
        fails |= {"B"} if 100 * len(set(ws)) < 50 * len(ws) else set()
        fails |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t) else set()
        fails |= {"D"} if any(c in "#$%&*|" for c in t) else set()
        fails |= {"E"} if i is not None and texts[t] < i else set()
        docs.append((source or "", fails, i in good, i in toxic))
    out = {}
    shapley = Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                hit = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] += len(hit)
                fails = [d for d in own if f in d[1]]
                out[part, "".join(order), step] = [len(left), len(hit), len(fails) - len(hit), sum(d[1] == {f} for d in own), sum(d[2] for d in hit), sum(d[3] for d in hit)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def result(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture(scope="module")
def labels(spark, rows):
    ids = [r[0] for r in rows if r[0] is not None]
    some = [(i, i % 3 % 2, int(i % 4 == 1)) for i in ids if i % 5] + [(7, 1, 0), (7, 0, 1), (12, None, None), (None, 1, 1), (99999, 1, 1)]
    return some, spark.createDataFrame(some, "doc_id bigint, quality int, toxic int")


def test_matches_brute_force(spark, docs, rows, labels, clashing):
    """Nulls, empty and long texts, copies, repeated rows, null ids and sources, several labels of a document, extra columns."""
    more = [(2000 + i, " ".join(f"Word{i % 3}x{j}" for j in range(250)), "host0") for i in range(9)] + [(3000, " ".join(map(str, range(300))), "host1")]
    extra = spark.createDataFrame([*more, (2001, more[1][1], "other"), (None, more[1][1], "other"), (-5, more[2][1], None)], KIND)
    table = clashing.drop("lang", "n_chars").unionByName(extra, allowMissingColumns=True)
    plain = [(r[0], r[1], r[3]) for r in rows] + [tuple(r) for r in extra.collect()]
    some, label = labels
    want = brute(plain, some)
    assert result(filter_audit.audit(filter_audit.mask_counts(table, label))) == want
    assert len({v[6] for v in want.values()}) > 10 and any(v[3] and v[4] and v[5] for v in want.values())


def test_empty_table(none, labels):
    out = filter_audit.audit(filter_audit.mask_counts(none, labels[1]))
    assert out.collect() == [] and out.schema["shapley"].dataType.typeName() == "long"


def test_shapley_of_every_mask(spark):
    """A document that fails k filters gives each of them 120 / k."""
    counts = spark.createDataFrame([(str(m), m, 1, 0, 0) for m in range(32)], "part string, mask int, n bigint, good bigint, toxic bigint")
    for r in filter_audit.audit(counts).collect():
        m, f = int(r.part), "ABCDE".index(r.filter_order[r.step - 1])
        assert r.shapley == (120 // bin(m).count("1") if m >> f & 1 else 0)
        assert r.kept + r.removed + r.redundant in (0, 1)


def test_large_counts_stay_exact(spark):
    n = 3 * 10**15 + 1
    counts = spark.createDataFrame([("p", 31, n, n, n), ("p", 5, n, 0, 0), ("p", 0, n, n, 0)], "part string, mask int, n bigint, good bigint, toxic bigint")
    got = {r.filter_order[r.step - 1]: r.shapley for r in filter_audit.audit(counts).collect()}
    assert got == {"A": 84 * n, "B": 24 * n, "C": 84 * n, "D": 24 * n, "E": 24 * n}


def test_very_long_texts():
    """Five megabytes of different words, of one word, of one unbroken word and of line ends."""
    assert filter_audit.failures(" ".join(map(str, range(800_000))).encode()) == 0
    assert filter_audit.failures(b"a " * 2_500_000) == 0b0010
    assert filter_audit.failures(("é" * 2_500_000 + "A" * 51_021).encode()) == 0b0101
    assert filter_audit.failures(("é" * 2_500_000 + "A" * 51_020).encode()) == 0b0001
    assert filter_audit.failures(b"\n" * 5_000_000 + b"|") == 0b1001
