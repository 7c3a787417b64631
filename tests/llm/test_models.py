import os
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeflow.llm import class_lm, language, pieces, quality_crf

# language


def scalar_states(net, text, d):
    """States of one direction of the network, a number at a time."""
    h = net.hidden.shape[1]
    state, out = [0.0] * h, {}
    sig = lambda v: 1 / (1 + math.exp(-v))
    for i in range(len(text)) if d == 0 else reversed(range(len(text))):
        a = [float(v) for v in net.inputs[d][text[i]]]
        u = [sum(state[j] * float(net.hidden[d][j, k]) for j in range(h)) for k in range(3 * h)]
        z, r = [sig(a[k] + u[k]) for k in range(h)], [sig(a[h + k] + u[h + k]) for k in range(h)]
        c = [math.tanh(a[2 * h + k] + r[k] * u[2 * h + k]) for k in range(h)]
        state = [state[k] + z[k] * (c[k] - state[k]) for k in range(h)]
        out[i] = state
    return out


def scalar_probabilities(net, text):
    fore, back, h = scalar_states(net, text, 0), scalar_states(net, text, 1), net.hidden.shape[1]
    for i in range(len(text)):
        both = fore[i] + back[i]
        e = [math.exp(sum(both[j] * float(net.output[j, k]) for j in range(2 * h)) + float(net.bias[k])) for k in range(len(net.names))]
        yield [v / sum(e) for v in e]


def test_gradients_match_differences():
    net = language.Network.fresh(["a", "b", "c"], h=4, seed=1)
    x, live, order = language.lanes([b"ab", b"c", b"\xc3\xa9fgh"])
    y = np.array([0, 2, 1])[order]
    _, grads = net.gradients(x, live, y)
    r = np.random.default_rng(0)
    for w, g in zip(net.weights(), grads, strict=True):
        hot = np.argwhere(np.abs(g) > 1e-3)
        for at in hot[r.permutation(len(hot))[:6]]:
            i, keep = tuple(at), w[tuple(at)]
            eps = np.float32(1e-2)
            w[i] = keep + eps
            up = net.gradients(x, live, y)[0]
            w[i] = keep - eps
            down = net.gradients(x, live, y)[0]
            w[i] = keep
            assert abs((up - down) / (2 * eps) - g[i]) < 0.05 * abs(g[i]) + 2e-3


def test_labels_and_pooling_match_a_scalar_network():
    """Texts of one window: states, labels of positions and pooled probabilities by brute force."""
    net = language.Network.fresh(["a", "b", "c"], h=3, seed=4)
    texts = ["ab 12 é!".encode(), b"word by word, on and on", b"x", b"", b"12 !", "日本".encode()]
    got, known = language.label(net, texts)
    assert known.tolist() == [True, True, True, False, False, True]
    for t, p, k in zip(texts, got, known, strict=True):
        each = list(scalar_probabilities(net, t))
        assert language.positions(net, t) == [net.names[max(range(3), key=lambda i: e[i])] for e in each]
        letters = [e for e, c in zip(each, t, strict=True) if chr(c).isascii() and chr(c).isalpha() or c >= 128]
        if k:
            assert np.allclose(p, np.mean(letters, axis=0), atol=1e-5)


def test_long_texts_are_read_in_windows(monkeypatch):
    """Each byte is judged in one window, with its neighbours' bytes around; windows begin at whole characters."""
    monkeypatch.setattr(language, "WINDOW", 50)
    monkeypatch.setattr(language, "MARGIN", 20)
    monkeypatch.setattr(language, "LANES", 7)
    net = language.Network.fresh(["a", "b"], h=3, seed=2)
    texts = ["日本語のテキスト".encode() * 20, b"", b"plain words " * 30, b"z" * 50, b"y" * 51, "é".encode() * 25]
    buf = np.frombuffer(b"".join(texts), np.uint8)
    text, begin, end, low, high = language.windows(np.array([len(t) for t in texts]), buf)
    at, first = 0, np.cumsum([0, *map(len, texts)])
    for t, b, e, lo, hi in zip(text, begin, end, low, high, strict=True):
        assert lo == at and first[t] <= b <= lo <= hi <= e <= first[t + 1]
        assert hi == first[t + 1] or 47 <= hi - lo <= 53
        assert lo - b in range(17, 24) or b == first[t]
        bytes(buf[b:e]).decode()
        at = hi
    got, _ = language.label(net, texts)
    for t, p in zip(texts, got, strict=True):
        if t:
            want, b = [], np.frombuffer(t, np.uint8)
            for _, s, e, lo, hi in zip(*language.windows(np.array([len(t)]), b), strict=True):
                each = list(scalar_probabilities(net, t[s:e]))
                want += [each[i - s] for i in range(lo, hi) if language._LETTER[t[i]]]
            assert np.allclose(p, np.mean(want, axis=0), atol=1e-5)


def test_reading_holds_few_bytes_for_each_of_its_own():
    """Scores are used up block by block; lanes of different lengths end and begin within blocks."""
    import tracemalloc

    net = language.Network.fresh(["a", "b", "c", "d"], seed=2)
    tracemalloc.start()
    try:
        language.label(net, [b"the quick brown fox jumps over the lazy dog " * 55_000])
        assert tracemalloc.get_traced_memory()[1] < 50e6
    finally:
        tracemalloc.stop()
    net = language.Network.fresh(["a", "b", "c"], h=3, seed=4)
    texts = [bytes(97 + (i * j) % 26 for j in range(i)) for i in (1, 7, 8, 9, 17, 40, 41)]
    x, live, order = language.lanes(texts)
    got = net.probabilities(x, live)
    for b, i in enumerate(order):
        assert np.allclose(got[: len(texts[i]), b], list(scalar_probabilities(net, texts[i])), atol=1e-5)


def test_languages_of_held_out_documents(docs, rows, none, clashing):
    known = docs.filter("doc_id < 1000")
    net = language.fit(known.filter(language.fold(F.col("doc_id"), 5) != 0), sample=80)
    got = {r.doc_id: r for r in language.predict(docs, net).collect()}
    held = [r for r in rows if r[0] is not None and r[0] < 1000 and zlib.crc32(str(r[0]).encode()) % 5 == 0 and "BUY" not in r[1] and len(r[1]) > 60]
    right = sum(got[r[0]].lang_pred == r[2] for r in held)
    assert right >= 0.85 * len(held) and len(held) > 5
    assert all(0 <= r.score <= 1 for r in got.values())
    for i in (1001, 1002, 1003):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert language.fit(none) is None and language.predict(docs, None).filter("lang_pred <> 'und'").count() == 0
    assert language.predict(none, net).count() == 0 and language.predict(clashing, net).count() == len(rows)
    assert language.fit(docs.withColumn("lang", F.lit(None).cast("string"))) is None


def test_drawn_stretches_spread_over_the_text():
    assert language.drawn(b"", 4, 8) == [] and language.drawn(b"abc", 4, 8) == [b"abc"]
    text = "日本語".encode() * 9
    parts = language.drawn(text, 4, 8)
    assert len(parts) == 4 and all(p[0] & 0xC0 != 0x80 for p in parts) and parts[-1] in text[-10:]


# quality


def brute_marginals(f, s):
    n = len(s)
    total, p = 0.0, np.zeros(n)
    for code in range(2**n):
        y = [(code >> i) & 1 for i in range(n)]
        w = math.exp(sum(s[i] * y[i] for i in range(n)) + sum(f.moves[y[i], y[i + 1]] for i in range(n - 1)))
        total += w
        p += w * np.array(y)
    return p / total


def test_forward_backward_matches_enumeration():
    r = np.random.default_rng(1)
    f = quality_crf.Field(np.zeros(3), r.standard_normal((2, 2)))
    s, n = r.standard_normal((3, 6)) * 3, np.array([6, 1, 4])
    p, pairs = f.marginals(s, n)
    for i in range(3):
        assert np.allclose(p[i, : n[i]], brute_marginals(f, s[i, : n[i]]))
    assert np.allclose(pairs.sum(axis=(1, 2)), n - 1)


def test_quality_of_held_out_documents(spark, docs, rows, none, clashing):
    labels = spark.createDataFrame([(r[0], 0 if "BUY" in r[1] else 1) for r in rows if r[0] is not None and r[0] < 1000] + [(3, None), (None, 1)], "doc_id bigint, quality int")
    f = quality_crf.fit(docs, labels.filter(quality_crf.fold(F.col("doc_id"), 3) != 1))
    got = {r.doc_id: r.score for r in quality_crf.scored(docs, f).collect()}
    for r in rows:
        if r[0] is not None and r[0] < 1000 and len(r[1]) > 40:
            assert (got[r[0]] >= 0.5) == ("BUY" not in r[1]), r[1][:80]
    assert all(0 <= s <= 1 for s in got.values()) and got[1001] == got[1002]
    assert quality_crf.scored(none, f).count() == 0 and quality_crf.scored(clashing, f).count() == len(rows)
    kept = quality_crf.keep(clashing, f)
    assert kept.columns == clashing.columns and kept.count() == sum(r.score >= 0.5 for r in quality_crf.scored(docs, f).collect())


def test_quality_without_labels(spark, docs):
    flat = quality_crf.fit(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert {r.score for r in quality_crf.scored(docs, flat).collect()} == {0.5}
    same = quality_crf.fit(docs, docs.filter("doc_id < 1000").select("doc_id", F.lit(1).alias("quality")))
    assert {r.score for r in quality_crf.scored(docs, same).collect()} == {0.5}


def test_training_stretches_spread_over_the_text():
    assert quality_crf.stretches(1) == [(0, 1)] and quality_crf.stretches(48) == [(0, 48)]
    assert quality_crf.stretches(200) == [(0, 16), (92, 108), (184, 200)]


def test_pooling_matches_the_scalar_form():
    """Marginals of every line by enumeration, weighted by the lines' lengths plus one."""
    r = np.random.default_rng(6)
    f = quality_crf.Field(r.normal(size=quality_crf.WIDTH), r.normal(size=(2, 2)))
    texts = [b"one line", b"", b"A b.\n\n### $$$\nwords and words", b"x\ny\nz\nx"]
    for t, got in zip(texts, quality_crf.quality(f, texts), strict=True):
        lines = quality_crf.Lines.of([t])
        x, size = quality_crf.line_features(lines, np.arange(len(lines.ends))), lines.ends - lines.starts
        p = brute_marginals(f, x @ f.weights)
        assert abs(got - sum(p * (size + 1)) / sum(size + 1)) < 1e-9


def test_line_features_know_their_neighbours():
    lines = quality_crf.Lines.of([b"a b\n\nC!", b"", b"q"])
    x, own = quality_crf.line_features(lines, np.arange(5)), quality_crf.OWN
    assert lines.counts.tolist() == [3, 1, 1] and (lines.ends - lines.starts).tolist() == [3, 0, 2, 0, 1]
    assert (x[1, own : 2 * own] == x[0, :own]).all() and (x[1, 2 * own :] == x[2, :own]).all()
    assert not x[0, own : 2 * own].any() and not x[2, 2 * own :].any() and not x[3, own:].any()


def test_slices_of_lines_change_nothing(monkeypatch):
    """Features, messages and scores are those of whole texts, wherever slices end."""
    r = np.random.default_rng(4)
    pool = [b"", b"A good line of words.", b"BUY ### NOW!!!", b"x", b"  ", "é d\u3000e".encode(), b"A good line of words."]
    texts = [b"\n".join(pool[i] for i in r.integers(0, len(pool), n)) for n in (0, 1, 2, 7, 40, 41, 3)]
    f = quality_crf.Field(r.normal(size=quality_crf.WIDTH), r.normal(size=(2, 2)))
    want = quality_crf.quality(f, texts)
    lines = quality_crf.Lines.of(texts)
    x = quality_crf.line_features(lines, np.arange(len(lines.ends)))
    some = np.unique(r.integers(0, len(lines.ends), 20))
    assert np.allclose(quality_crf.emissions(lines, f.weights), x @ f.weights) and lines.again.sum() > 20
    p, pairs = f.marginals((x[:40] @ f.weights)[None], np.array([40]))
    for size in (1, 2, 3, 16):
        monkeypatch.setattr(quality_crf, "SLICE", size)
        cut = quality_crf.Lines.of(texts)
        assert (cut.again == lines.again).all() and (quality_crf.line_features(cut, some) == x[some]).all()
        assert np.allclose(quality_crf.quality(f, texts), want, atol=1e-12)
        q, qs = f.marginals((x[:40] @ f.weights)[None], np.array([40]))
        assert np.allclose(p, q) and np.allclose(pairs, qs)


def test_a_text_of_many_line_ends_stays_small():
    import subprocess
    import sys

    code = "import resource, numpy as np\nfrom placeflow.llm import quality_crf as q\nf = q.Field(np.linspace(-1, 1, q.WIDTH), np.eye(2))\n"
    code += "base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\nprint(len(q.quality(f, [b'\\n' * 400_000])), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base)"
    n, kb = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(__file__))), timeout=300).stdout.split())
    assert n == 1 and kb * 1024 < 250 * 400_000


# class model


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def test_scores_match_brute_force(docs, rows, none, clashing):
    train = docs.filter(class_lm.fold(F.col("doc_id"), 7) != 2)
    model, counts = class_lm.fit(train)
    c = Counter()
    for r in rows:
        if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 != 2:
            c.update(tokens(r[1]))
    n, v = sum(c.values()), len(c)
    assert (model.tokens, model.distinct) == (n, v)
    own = dict(zip([*model.words], model.classes[: len(model.words)].tolist(), strict=True))
    cls = lambda w: class_lm.CLASSES if w == b"" else own.get(w, model.classes[len(model.words) + class_lm.pool(w)])
    want = Counter()
    for r in rows:
        t = tokens(r[1])
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)
        prev, score = class_lm.CLASSES, 0.0
        for w in t:
            k = cls(w)
            score += model.moves[prev, k] + math.log10(c[w] + 1) - model.shares[k]
            prev = k
        want[(r[0], len(t), sum(c[w] > 0 for w in t), round(base, 5), round(score, 5))] += 1
    got = Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 5), round(r.score, 5)) for r in class_lm.scored(docs, model, counts).collect())
    assert got == want
    assert class_lm.scored(none, model, counts).count() == 0
    assert class_lm.scored(clashing.select("doc_id", "text"), model, counts).count() == len(rows)
    assert np.allclose((10**model.moves).sum(axis=1), 1)


def test_rare_words_meet_their_counts_in_the_join(docs, monkeypatch):
    monkeypatch.setattr(class_lm, "HELD", 5)
    whole = {(r.doc_id, r.n_tokens): r.base_score for r in class_lm.scored(docs, *class_lm.fit(docs)).collect()}
    monkeypatch.setattr(class_lm, "KNOWN", 3)
    monkeypatch.setattr(class_lm, "WORDS", 3)
    few = {(r.doc_id, r.n_tokens): r.base_score for r in class_lm.scored(docs, *class_lm.fit(docs)).collect()}
    assert whole.keys() == few.keys() and all(abs(whole[k] - few[k]) < 1e-6 for k in whole)


def test_exchange_finds_the_classes():
    r = np.random.default_rng(4)
    kinds = np.array([0] * 10 + [1] * 10 + [2] * 10)
    pairs = np.zeros((31, 31))
    at = 30
    for _ in range(6000):
        k = 0 if at == 30 else (kinds[at] + 1) % 3
        nxt = 30 if r.random() < 0.05 else int(r.choice(np.flatnonzero(kinds == k)))
        pairs[at, nxt] += 1
        at = nxt
    own = class_lm.exchange(pairs, classes=3, sweeps=8)
    assert own[30] == 3
    for k in range(3):
        assert len(set(own[:30][kinds == k].tolist())) == 1
    assert len(set(own.tolist())) == 4


def likelihood(pairs, own, classes):
    g = np.zeros((classes + 1, classes + 1))
    np.add.at(g, (own[:, None], own[None, :]), pairs)
    return class_lm._h(g).sum() - class_lm._h(g.sum(axis=0)).sum() - class_lm._h(g.sum(axis=1)).sum()


def balanced(pairs):
    """Pair counts in which each word follows as often as it is followed, by the end's share."""
    pairs[-1] += np.maximum(pairs.sum(axis=1) - pairs.sum(axis=0), 0)
    pairs[:, -1] += np.maximum(pairs.sum(axis=0) - pairs.sum(axis=1), 0)
    return pairs


def test_words_choose_the_class_of_the_greatest_likelihood():
    r = np.random.default_rng(6)
    n, classes = 40, 5
    pairs = balanced(np.floor(r.exponential(0.7, (n, n))) * r.integers(0, 30, (n, n)) * (r.random((n, n)) < 0.3))
    pairs[3, 3] = 7
    own = np.append(r.integers(0, classes, n - 1), classes)
    hot = np.eye(classes + 1)[own]
    got = class_lm.chooser(hot.T @ pairs @ hot)(own[:-1], (pairs @ hot)[:-1], (pairs.T @ hot)[:-1], np.diagonal(pairs)[:-1])
    for w in range(n - 1):
        all_of = [likelihood(pairs, np.where(np.arange(n) == w, b, own), classes) for b in range(classes)]
        assert all_of[got[w]] > max(all_of) - 1e-6


def test_exchange_goes_on_until_no_word_moves():
    r = np.random.default_rng(8)
    pairs = balanced(np.floor(r.exponential(1.0, (300, 300)) * 3))
    own = class_lm.exchange(pairs, classes=12)
    for w in range(0, 299, 7):
        all_of = [likelihood(pairs, np.where(np.arange(300) == w, b, own), 12) for b in range(12)]
        assert all_of[own[w]] > max(all_of) - 1e-6


def test_rare_words_take_the_class_of_their_neighbours(spark, monkeypatch):
    """Two kinds of rare words with the same last bytes, one in the places of names and one in those of verbs."""
    monkeypatch.setattr(class_lm, "WORDS", 10)
    monkeypatch.setattr(class_lm, "HELD", 50)
    r = np.random.default_rng(2)
    texts = []
    for i in range(600):
        name, verb = (f"n{i % 60}xyz", f"v{i % 60}xyz") if i % 2 else (r.choice(["anna", "bob"]), r.choice(["run", "go"]))
        texts.append(f"{r.choice(['the', 'a'])} {name} {r.choice(['can', 'may'])} {verb} {r.choice(['now', 'soon'])}")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    model, classed = class_lm.fit(docs)
    got = {w.word: (w["n"], w["class"]) for w in classed.collect()}
    counts = Counter(w for t in texts for w in t.split())
    assert {w: n for w, (n, _) in got.items() if w} == dict(counts)
    of = {kind: {c for w, (_, c) in got.items() if w.startswith(kind) and w.endswith("xyz")} for kind in "nv"}
    assert not of["n"] & of["v"]
    # the class table counts the rare words where they now are
    n = np.zeros(class_lm.CLASSES + 1)
    for _, (k, c) in got.items():
        n[c] += k
    monkeypatch.setattr(class_lm, "KNOWN", 3)
    few, _ = class_lm.fit(docs)
    assert np.allclose(few.moves, model.moves) and np.allclose(n.sum(), model.tokens)
    a, b = ({x.doc_id: x.score for x in class_lm.scored(docs, m, classed).collect()} for m in (model, few))
    assert all(abs(a[k] - b[k]) < 1e-6 for k in a)


def test_no_training_text(none, docs):
    model, counts = class_lm.fit(none)
    out = class_lm.scored(docs, model, counts).collect()
    assert all(r.n_known == 0 and r.base_score == 0 for r in out) and model.tokens == 0


# pieces


@pytest.fixture(scope="module")
def model_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def test_encoding_matches_the_library_under_the_unigram_rule(spark, docs, rows, model_path):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(model_path, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        if p.type == 1 and p.score < pieces.NEVER:
            p.type = 5
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    table, known = pieces.piece_table(spark, model_path)
    coded = {r.segment: list(r.ids) for r in pieces.encode(pieces.segment_counts(docs, known), table, known, "n").collect()}
    for r in rows:
        if r[1] and "\x00" not in r[1] and r[0] is not None and r[0] < 1000:
            mine = [i for s in pieces.segments(r[1].encode(), known) for i in coded[s.decode()]]
            assert mine == sp.encode(r[1])


def test_whole_documents_and_round_trip(docs, rows, none, clashing, model_path, monkeypatch):
    whole = Counter(map(tuple, pieces.documents(docs, model_path).collect()))
    marked = {r[0] for r in rows if "▁" in (r[1] or "")}
    assert all(r[4] == (r[0] not in marked) for r in whole) and marked
    assert sum(r[1] == r[2] == 0 for r in whole.elements()) == sum(not r[1] for r in rows)
    monkeypatch.setattr(pieces, "KNOWN", 5)
    assert Counter(map(tuple, pieces.documents(docs, model_path).collect())) == whole
    assert pieces.documents(none, model_path).count() == 0 and pieces.documents(clashing, model_path).count() == len(rows)


def test_segments_join_to_the_text(model_path, spark):
    _, known = pieces.piece_table(spark, model_path)
    for t in ["a  b", " x\n\n y. z", "a\0b ▁c", "", "..a,b", "\n", "é日本 語"]:
        assert b"".join(pieces.segments(t.encode(), known)).decode() == (" " + t.replace("▁", " ") if t else "")
    assert known["longest"] == 16


def test_ids_of_documents_decode_to_their_texts(spark, docs, rows, model_path, monkeypatch):
    table, known = pieces.piece_table(spark, model_path)
    words = pieces.segment_ids(docs.select("doc_id", "text"), table, known)
    own = {r.segment: list(r.ids) for r in words.collect()}
    for listed in (pieces.KNOWN, 7):
        monkeypatch.setattr(pieces, "KNOWN", listed)
        coded = pieces.encoded(docs, words, known)
        want = Counter((r[0], tuple(i for s in pieces.segments((r[1] or "").encode(), known) for i in own[s.decode()])) for r in rows)
        assert Counter((r.doc_id, tuple(r.ids)) for r in coded.collect()) == want
    back = Counter(map(tuple, pieces.decode(coded, known).collect()))
    assert back == Counter((r[0], (r[1] or "").replace("▁", " ")) for r in rows)


def test_edges_are_grouped_once_and_segments_read_without_scalars(spark, model_path, capsys):
    import pyarrow as pa

    table, known = pieces.piece_table(spark, model_path)
    texts = ["a", " the", "x\0", "é日本", "abababababababababababab"]
    lattice = pieces._stops(spark.createDataFrame([(t,) for t in texts], "segment string"), table, known, ["segment"], False)
    lattice.explain()
    assert capsys.readouterr().out.count("ObjectHashAggregate(") == 2  # before and after the exchange
    scores = {r.piece: (r.id, r.score) for r in table.collect()}
    for r in lattice.collect():
        want = [{(n, *scores.get(r.segment[e - n : e], (None, None))) for n in range(1, min(e, 16) + 1) if n == 1 or r.segment[e - n : e] in scores} for e in range(1, len(r.segment) + 1)]
        got = [{(e.n, e.id if e.id >= 0 else None, e.score if e.id >= 0 else None) for e in s.edges} for s in r.stops]
        assert got == want
    coded = pa.array([b"a", b"", "é".encode(), b"bc"], pa.large_binary())
    assert pieces._items(coded) == coded.to_pylist() and pieces._items(coded.slice(1, 2)) == [b"", "é".encode()]
    assert pieces._items(coded[:0]) == pieces._items(pa.array([], pa.large_binary())) == []
    assert pieces.decoded(pa.array([[], [], []], pa.list_(pa.int32())), known) == [b""] * 3


def test_texts_are_cut_once_for_the_counts(spark, docs, model_path, monkeypatch):
    """Short and long segments are both taken from kept counts."""
    table, known = pieces.piece_table(spark, model_path)
    seen = []
    encode = pieces.encode
    monkeypatch.setattr(pieces, "encode", lambda words, *a: seen.append(words._jdf.queryExecution().toString()) or encode(words, *a))
    assert pieces.segment_ids(docs.select("doc_id", "text"), table, known).count() > 0
    assert len(seen) == 1 and "MapInArrow" not in seen[0]


def test_pieces_that_never_win_are_left_out_and_change_nothing(spark, docs, model_path, monkeypatch):
    assert pieces._may_win({"a": -9.0, "b": -9.0, "ab": -3.0, "aba": -12.0, "abb": -12.5, "abab": -6.0, "c": -1.0, "cc": -2.5, "zc": -50.0}) == [True, True, True, True, False, True, True, False, True]
    some, known = pieces.piece_table(spark, model_path)
    with monkeypatch.context() as m:
        m.setattr(pieces, "_may_win", lambda scores: [True] * len(scores))
        every, same = pieces.piece_table(spark, model_path)
    assert some.count() < every.count() / 2 and some.subtract(every).count() == 0
    assert known["longest"] == same["longest"] and (known["cuts"] == same["cuts"]).all()
    counts = pieces.written(pieces.segment_counts(docs, known))
    got = {r.segment: r.ids for r in pieces.encode(counts, some, known, "n").collect()}
    assert got == {r.segment: r.ids for r in pieces.encode(counts, every, same, "n").collect()} and len(got) == counts.count()
    monkeypatch.setattr(pieces, "LONG", 2)  # all but the shortest go by blocks
    assert got == {r.segment: r.ids for r in pieces.encode(counts, every, same, "n").collect()}


def test_ties_go_to_the_longest_last_piece_in_both_folds(spark, monkeypatch):
    rows = [("a", 300, -2.0), ("aa", 301, -4.0), ("aaa", 302, -6.0), ("b", 303, -1.5)]
    table = spark.createDataFrame(rows, "piece string, id int, score double")
    known = {"longest": 3, "unknown": -20.0, "byte": 3}
    texts = spark.createDataFrame([(w,) for w in ("a", "aaaa", "aabaaaaa", "xé", "aaxaaaa\0b")], "segment string")
    want = {"a": [300], "aaaa": [300, 302], "aabaaaaa": [301, 303, 301, 302], "xé": [3 + 0x78, 3 + 0xC3, 3 + 0xA9], "aaxaaaa\0b": [301, 3 + 0x78, 300, 302, 3, 303]}
    assert {r.segment: r.ids for r in pieces.encode(texts, table, known).collect()} == want
    monkeypatch.setattr(pieces, "LONG", 0)
    assert {r.segment: r.ids for r in pieces.encode(texts, table, known).collect()} == want


def test_long_segments_fold_in_proportion(spark, model_path, monkeypatch):
    """Segments over several blocks of the fold equal those folded at once, and a long one takes no more time than its length asks for."""
    import random
    import time

    r = random.Random(4)
    table, known = pieces.piece_table(spark, model_path)
    letters = "etaoinshrdlu"
    texts = ["".join(r.choice(letters) for _ in range(n)) for n in (15, 16, 17, 63, 64, 65, 255, 256, 257, 511, 512, 513, 1100)] + ["é" * 40 + "\0日" * 40]
    df = spark.createDataFrame([(t,) for t in texts], "segment string")
    parted = {x.segment: x.ids for x in pieces.encode(df, table, known).collect()}
    monkeypatch.setattr(pieces, "FOLDED", 1 << 20)
    assert {x.segment: x.ids for x in pieces.encode(df, table, known).collect()} == parted
    monkeypatch.undo()
    took = []
    for n in (4_000, 16_000, 32_000, 64_000):  # the first one compiles
        began = time.perf_counter()
        long = spark.createDataFrame([("".join(r.choice(letters) for _ in range(n)),)], "segment string")
        ids = pieces.encode(long, table, known).first().ids
        took.append(time.perf_counter() - began)
        assert len(ids) > n // 8
    assert took[3] < 2.5 * took[2] + 1 and took[3] < 6 * took[1] + 1  # the square of the length would be 4 and 16 times
