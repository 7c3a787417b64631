import os
import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeflow.llm import toxicity
from placeflow.llm.common import fold, table

WORDS = {"idiot": 5.0, "trash": 4.0, "bobo*": 3.0}


def heaviest(parts, symbols):
    """The best weight over all paths through one transducer after another, by listing every path."""

    def paths(t, tape):
        now = [(t.start, 0.0, ())]
        for s in tape:
            now = [(to, w + v, (*out, o)) for state, w, out in now for o, v, to in t.arcs.get((state, s), ())]
        return {(out, w) for state, w, out in now if state in t.final}

    tapes = {(tuple(symbols), 0.0)}
    for t in parts:
        tapes = {(out, w + v) for tape, w in tapes for out, v in paths(t, tape)}
    best = max(w for _, w in tapes)
    return best, {tuple(o for o in out if o not in ("x", "Q")) for out, w in tapes if w == best}


def test_composition_equals_the_cascade():
    parts = [toxicity.negation(), toxicity.reported(), toxicity.target(), toxicity.threat(), toxicity.insult()]
    r = random.Random(1)
    tapes = ["".join(p) for n in (1, 2) for p in product("xTNRQIH", repeat=n)] + ["".join(r.choice("xxTNRQIIH") for _ in range(r.randint(3, 8))) for _ in range(250)]
    for tape in tapes:
        weight, events = toxicity.grammar().heaviest(tape)
        want, outputs = heaviest(parts, tape)
        assert weight == pytest.approx(want) and tuple(events) in outputs, tape


def read(text, words=WORDS):
    tags = [toxicity.tagged(w.encode(), words) for w in text.split()]
    weight, events = toxicity.reading("".join(t[0] for t in tags))
    return [toxicity.EVENTS[e] for e in events], weight


@pytest.mark.parametrize(
    ("clause", "events", "weight"),
    [
        ("what an idiot", ["I"], 0), ("You are an Idiot!!", ["I@"], 1), ("idiot that you are", ["I@"], 1), ("you a b c d e idiot", ["I"], 0),
        ("you are not an idiot", ["i@"], -0.5), ("not a b c idiot", ["I"], 0), ("not a b idiot", ["i"], -1.5), ("he said idiot", ["I'"], -1),
        ('the word "idiot" here', ["I'"], -1), ('the "word" idiot', ["I"], 0), ("he said you idiot", ["I'@"], 0), ("I will kill you", ["H@"], 1), ("kill time", ["H"], -1.5),
        ("idiot trash", ["I", "I"], 0.5), ("you idiot trash", ["I@", "I@"], 2.5), ("idiot a b c trash", ["I", "I"], 0), ("ich werde dich töten", ["H@"], 1), ("Bobosta", ["I"], 0), ("bob", [], 0),
        ("he never said you idiot", ["i'@"], -1.5),
    ],
)
def test_clauses(clause, events, weight):
    assert read(clause) == (events, pytest.approx(weight))


def test_fillers_beyond_all_scopes_change_nothing():
    for a, b in (("xxxxxxTxxxI", 7), ("NIxxxxxxxxT", 9), ("RxxxxxxxI", 40)):
        long = a.replace("xxxxxx", "x" * (6 + b))
        assert toxicity.reading(a) == toxicity.reading(long) == toxicity.grammar().heaviest(long)[:1] + ([toxicity.EVENTS.index(e) for e in toxicity.grammar().heaviest(long)[1]],)


def test_features_by_hand():
    text = b"you idiot. what trash\nnot idiot said who \xff\n\n  kill"
    x = toxicity.clause_features([b"", text, b" \n ", b"all is well."], WORDS)
    assert (x[[0, 2], 1:] == 0).all() and (x[3, 1:5] == 0).all() and x[3, 5] == np.log1p(3) / 5
    total = 6 + 4 + 3.5 + 0.5  # targeted; plain; negated; a threat without a target
    assert x[1, 1] == pytest.approx(np.log1p(total)) and x[1, 2] == pytest.approx(np.log1p(100 * total / 30) / 2)
    assert x[1, 3] == pytest.approx(0.6) and x[1, 4] == 1
    found = {toxicity.EVENTS[i]: v for i, v in enumerate(x[1, 6:]) if v}
    assert found == {e: pytest.approx(np.log1p(100 / 30)) for e in ("I@", "I", "i", "H")}
    # texts of a batch don't touch each other
    both = toxicity.clause_features([b"you", text, b"you"], WORDS)
    assert (both[1] == x[1]).all()


def test_lexicon(spark):
    """Words and stems of toxic documents come in, common ones and rare ones don't; stems stand for their words."""
    r = random.Random(2)
    common = [f"{a}{b}" for a in ("lo", "mi", "ta", "ne") for b in ("ra", "sol", "vin", "dor", "k", "pem")]
    rows = []
    for i in range(200):
        ws = [r.choice(common) + r.choice(["", ".", "!"]) for _ in range(60)]
        if i % 4 == 0:
            ws += ["Grob!", *(f"schmu{r.choice(common)}" for _ in range(4))]
            ws += [f"once{i}"] * 9
        rows.append((" ".join(ws), int(i % 4 == 0)))
    rows += [(None, 0), ("", 1), ("...", 1)]
    got = toxicity.lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert got["grob"] > 3 and got["schmu*"] > 3 and not any(w.startswith("schmu") and w != "schmu*" for w in got) and "once0" not in got
    assert set(got) <= {"grob", "schmu*", "once*"}  # what shares its four letters in all toxic documents is a stem too


def test_odd_rows(spark, docs, rows, none, clashing):
    labels = spark.createDataFrame([(r[0], int("BUY" in (r[1] or ""))) for r in rows if r[0] is not None] + [(None, 1), (7, None), (8, 1), (8, 0), (123456, 1)], "doc_id bigint, toxic int")
    model = toxicity.learn(clashing, labels)
    got = toxicity.scored(clashing, model).collect()
    assert sorted((r.doc_id or -1) for r in got) == sorted((r[0] or -1) for r in rows) and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score)
    texts = {}
    for r in rows:
        texts.setdefault(r[1] or "", set()).update(by[r[0]] if r[0] is not None else ())
    assert all(len(s) <= 1 for s in texts.values())  # equal texts, equal scores
    assert by[1001] == by[1002]
    junk = [by[r[0]] for r in rows if "BUY" in (r[1] or "")]
    assert all(max(s) > 0.5 for s in junk)
    # without labels, with one class only, and without rows the fixed weights hold
    for known in (labels.limit(0), labels.filter("toxic = 0")):
        m = toxicity.learn(docs, known)
        assert m.lexicon == {} and (m.weights == toxicity.PRIOR).all()
    assert toxicity.learn(none, labels).lexicon == {} and toxicity.scored(none, model).collect() == []


def test_repeated_ids_stay_bounded(spark):
    """Rows that share a doc_id train as one."""
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "other")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")
    assert toxicity.learn(docs, labels).lexicon == {}


def test_very_long_texts():
    """Five megabytes without a blank, of line ends, of one clause of insults, and of many different words with one attack at the end."""
    texts = [b"x" * 5_000_000, b"\n" * 5_000_000, b"idiot " * 100_000, " ".join(map(str, range(800_000))).encode() + b". you idiot"]
    x = toxicity.clause_features(texts, WORDS)
    assert (x[:2, 1:5] == 0).all() and x[2, 1] == pytest.approx(np.log1p(5 * 100_000 + 0.5 * 99_999)) and x[3, 1] == pytest.approx(np.log1p(6))


def test_weights_are_the_likeliest():
    r = np.random.default_rng(0)
    x = np.column_stack([np.ones(400), r.normal(size=(400, toxicity.WIDTH - 1))])
    y = (r.random(400) < 1 / (1 + np.exp(-2 * x[:, 1] + x[:, 2]))).astype(float)
    w = toxicity.fitted(x, y)
    slope = x.T @ (toxicity.probability(x, w) - y) + 0.3 * (w - toxicity.PRIOR)
    assert np.abs(slope).max() < 1e-3


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the driver's tables")
def test_held_out_accuracy(spark):
    where = "/root/testdata/sf0.1"
    got = toxicity.op12_clause_grammar(spark, where)
    n = table(spark, where, "documents").count()
    rows = got.join(table(spark, where, "labels"), "doc_id").filter("held_out").select("predicted", "toxic").collect()
    assert got.count() == n and got.filter(F.col("held_out") != (fold(F.col("doc_id"), 5) == 0)).count() == 0
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in rows)
    assert hit >= 0.9 * sum(r.toxic for r in rows) and hit >= 0.95 * sum(r.predicted for r in rows)
