"""Operator 12: toxicity from a weighted finite-state grammar of clauses.

A text is cut into clauses at line ends and after words that end in `.!?;`.
Each word has a tag (insult, threat, target, negation, reporting verb, other)
and quotation marks have one of their own. The tags of a clause run through
five weighted transducers, composed into one:

* negation: an insult or threat up to `SCOPE` words after a negation is negated;
* reported speech: what follows a reporting verb or stands in quotation marks is reported;
* target: a person addressed up to `NEAR` words before or after (the transducer
  promises a target and fails if none comes) makes an attack a targeted one;
* threat: a threat without a target weighs less;
* insult: an insult up to `STACK` words after another weighs more.

Weights add along a path, and the heaviest path is the clause's reading. The
clause weighs its path and the lexical weights of its attacking words; what is
below zero is no match. A document's score is logistic in its matched clauses:
their sum, their density, the heaviest one, and each kind of event.

The lexicon of insults is learned: the words and stems (first 3 to 8 letters)
that labelled toxic documents use more than others do, by the log of the ratio
of rates, if a likelihood ratio test and `SUPPORT` documents confirm it. A stem
stands for all words that begin with it, and no entry begins with another. The
logistic weights are fitted around fixed ones, which hold where labels say nothing.

Training uses a bounded sample: the `SAMPLE` labelled documents with the least
hash of doc_id among those allowed, whole texts; at most `LEXICON` entries and
a row of `WIDTH` numbers for each of them reach the driver. Scoring reads whole
texts. Without labels, or with one class only, there are no learned insults and
the fixed weights hold. Of several labels of a document the largest counts, of
several texts with one doc_id the largest trains. A null text is an empty one,
which has no clause and scores as any text without a match. Rows are judged
alone, so repeated rows get the same score; a score of exactly 0.5 predicts 1;
readings that weigh the same go to the one with the less attack targeted. An
empty table gives no rows; extra columns are ignored. A very long text is one
row of a batch, with some 80 bytes for each of its words; a clause takes some
200 bytes for each attacking word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.llm.common import chunks, columns, discarded, fold, least, raw, table, written
from placeflow.llm.tokens import coded_words

SAMPLE, LEXICON = 20_000, 4000
#: Least documents of a lexicon entry, least log of its rates' ratio, least likelihood ratio statistic.
SUPPORT, RATIO, CERTAIN = 4, 1.4, 30.0
STEMS = range(3, 9)
SCOPE, NEAR, STACK = 3, 4, 2
#: Weights on the arcs.
NEGATED, REPORTED, TARGETED, AIMLESS, STACKED = -1.5, -1.0, 1.0, -1.5, 0.5
#: Lexical weight of a threatening verb.
THREAT_WEIGHT = 2.0

# Words of the grammar in English, German, French and Spanish.
THREATS = "kill hurt destroy shoot stab punch strangle murder töten umbringen erschießen verprügeln tuer frapper égorger matar golpear disparar"
TARGETS = "you your you're yourself dich dir du euch vous toi votre ton usted ustedes tú ti vosotros"
NEGATIONS = "not no never isn't aren't don't won't nicht kein keine niemals jamais aucun nunca jamás"
REPORTERS = "said says wrote claimed quoted sagte schrieb behauptete dit écrit dijo escribió"

OTHER, TARGET, NEGATION, REPORTER, QUOTE, INSULT, THREAT = "xTNRQIH"
EVENTS = [k + r + t for k in (INSULT, INSULT.lower(), THREAT, THREAT.lower()) for r in ("", "'") for t in ("", "@")]
_EVENT = {e: i for i, e in enumerate(EVENTS)}
_MARKS = "\"“”„«»"
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_FILLER = re.compile("x{%d,}" % (max(SCOPE, NEAR, STACK) + 2))
WIDTH = 6 + len(EVENTS)
#: Fixed logistic weights: base, log of the sum, log of the density, heaviest clause, share of clauses, log of the words.
PRIOR = np.array([-4.0, 0.5, 1.0, 0.3, 0.0, 0.0] + [0.0] * len(EVENTS))


@dataclass
class Transducer:
    """Arcs (state, input) -> [(output, weight, state)]; a path ends in a final state."""

    start: object
    arcs: dict[tuple, list[tuple]] = field(default_factory=dict)
    final: set = field(default_factory=set)

    def arc(self, state: object, symbol: str, output: str, weight: float, to: object) -> None:
        self.arcs.setdefault((state, symbol), []).append((output, weight, to))

    def then(self, other: Transducer) -> Transducer:
        """The composition: what this one puts out, the other one reads."""
        symbols: dict[object, list[tuple[str, list[tuple]]]] = {}
        for (state, symbol), arcs in self.arcs.items():
            symbols.setdefault(state, []).append((symbol, arcs))
        out = Transducer((self.start, other.start))
        todo, seen = [out.start], {out.start}
        while todo:
            a, b = now = todo.pop()
            if a in self.final and b in other.final:
                out.final.add(now)
            for symbol, arcs in symbols.get(a, []):
                for middle, w, to in arcs:
                    for output, v, end in other.arcs.get((b, middle), []):
                        out.arc(now, symbol, output, w + v, (to, end))
                        if (to, end) not in seen:
                            seen.add((to, end))
                            todo.append((to, end))
        return out

    def heaviest(self, symbols: str) -> tuple[float, list[str]]:
        """Weight and outputs (without fillers) of the heaviest path; of equal ones the first found."""
        now: dict[object, tuple[float, tuple | None]] = {self.start: (0.0, None)}
        for s in symbols:
            after: dict[object, tuple[float, tuple | None]] = {}
            for state, (w, path) in now.items():
                for output, v, to in self.arcs.get((state, s), ()):
                    if to not in after or w + v > after[to][0]:
                        after[to] = (w + v, path if output in (OTHER, QUOTE) else (path, output))
            now = after
        weight, path = max((now[s] for s in now if s in self.final), key=lambda x: x[0])
        outputs: list[str] = []
        while path:
            path, output = path
            outputs.append(output)
        return weight, outputs[::-1]


def negation() -> Transducer:
    t = Transducer(0, final=set(range(SCOPE + 1)))
    for left in range(SCOPE + 1):
        less = max(left - 1, 0)
        t.arc(left, NEGATION, OTHER, 0, SCOPE)
        t.arc(left, QUOTE, QUOTE, 0, left)
        for s in (OTHER, TARGET, REPORTER):
            t.arc(left, s, s, 0, less)
        for s in (INSULT, THREAT):
            t.arc(left, s, s.lower() if left else s, NEGATED if left else 0, less)
    return t


def reported() -> Transducer:
    t = Transducer("direct", final={"direct", "told", "quoted"})
    for state in ("direct", "told", "quoted"):
        t.arc(state, REPORTER, OTHER, 0, "told" if state == "direct" else state)
        t.arc(state, QUOTE, QUOTE, 0, "direct" if state == "quoted" else "quoted")
        for s in (OTHER, TARGET):
            t.arc(state, s, s, 0, state)
        for s in (INSULT, THREAT, INSULT.lower(), THREAT.lower()):
            t.arc(state, s, s if state == "direct" else s + "'", 0 if state == "direct" else REPORTED, state)
    return t


def target() -> Transducer:
    """States: for how many words a target seen still counts, and within how many a promised one must come (0: none promised)."""
    t = Transducer((0, 0), final={(seen, 0) for seen in range(NEAR + 1)})
    for seen in range(NEAR + 1):
        for due in range(NEAR + 1):
            now, less = (seen, due), max(seen - 1, 0)
            t.arc(now, QUOTE, QUOTE, 0, now)
            t.arc(now, TARGET, OTHER, 0, (NEAR, 0))
            if due == 1:  # the promise is broken
                continue
            t.arc(now, OTHER, OTHER, 0, (less, max(due - 1, 0)))
            for s in (k + r for k in "IHih" for r in ("", "'")):
                t.arc(now, s, s, 0, (less, max(due - 1, 0)))
                t.arc(now, s, s + "@", TARGETED, (less, max(due - 1, 0) if seen else due - 1 if due else NEAR))
    return t


def threat() -> Transducer:
    t = Transducer(0, final={0})
    for e in EVENTS:
        t.arc(0, e, e, AIMLESS if e[0] in "Hh" and "@" not in e else 0, 0)
    for s in (OTHER, QUOTE):
        t.arc(0, s, s, 0, 0)
    return t


def insult() -> Transducer:
    t = Transducer(0, final=set(range(STACK + 1)))
    for left in range(STACK + 1):
        less = max(left - 1, 0)
        t.arc(left, QUOTE, QUOTE, 0, left)
        t.arc(left, OTHER, OTHER, 0, less)
        for e in EVENTS:
            own = e[0] in "Ii"
            t.arc(left, e, e, STACKED if own and left else 0, STACK if own else less)
    return t


@cache
def grammar() -> Transducer:
    return reduce(Transducer.then, (negation(), reported(), target(), threat(), insult()))


_READ: dict[str, tuple[float, list[int]]] = {}


def reading(tags: str) -> tuple[float, list[int]]:
    """Weight and events of a clause. Fillers beyond all scopes change nothing, so clauses alike but for them are read once."""
    tags = _FILLER.sub("x" * (max(SCOPE, NEAR, STACK) + 1), tags)
    if tags not in _READ:
        if len(_READ) > 50_000:
            _READ.clear()
        weight, events = grammar().heaviest(tags)
        if len(tags) > 200:
            return weight, [_EVENT[e] for e in events]
        _READ[tags] = weight, [_EVENT[e] for e in events]
    return _READ[tags]


@dataclass
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)  # whole words, and stems followed by *
    weights: np.ndarray = field(default_factory=PRIOR.copy)


_CLASS = {w: tag for tag, listed in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORTER, REPORTERS)) for w in listed.split()}


def core(word: bytes) -> str:
    """The word in lower case without marks at its edges."""
    return _EDGE.sub("", word.decode("utf-8", "replace").lower())


def tagged(word: bytes, lexicon: dict[str, float]) -> tuple[str, float, bool]:
    """Tags of a word (with those of its quotation marks), its lexical weight, and if it ends a clause."""
    text = word.decode("utf-8", "replace")
    bare = _EDGE.sub("", text.lower())
    weight = lexicon.get(bare, 0.0)
    for n in STEMS:
        if weight or n > len(bare):
            break
        weight = lexicon.get(bare[:n] + "*", 0.0)
    tag = INSULT if weight else _CLASS.get(bare, OTHER)
    if tag == THREAT:
        weight = THREAT_WEIGHT
    tail = text.rstrip(_MARKS + "')]}*#$%&|,")
    marks = (QUOTE * (text[0] in _MARKS), QUOTE * (len(text) > 1 and any(c in _MARKS for c in text[len(text.rstrip(_MARKS + ".!?;,")) :])))
    return marks[0] + tag + marks[1], weight, tail[-1:] in (".", "!", "?", ";")


_TAGS: dict[bytes, tuple[str, float, bool]] = {}
_OWNER: list[object] = [None]


def _tags(words: list[bytes], lexicon: dict[str, float]) -> list[tuple[str, float, bool]]:
    """Tags of distinct words; a worker keeps those of one lexicon."""
    if _OWNER[0] is not lexicon or len(_TAGS) > 200_000:
        _TAGS.clear()
        _OWNER[0] = lexicon
    out = []
    for w in words:
        if w not in _TAGS:
            _TAGS[w] = tagged(w, lexicon)
        out.append(_TAGS[w])
    return out


_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(b" \t\n\x0b\x0c\r")] = True


def clause_features(texts: list[bytes], lexicon: dict[str, float]) -> np.ndarray:
    """Row of WIDTH numbers for each text."""
    out = np.zeros((len(texts), WIDTH))
    out[:, 0] = 1
    words, codes, counts, _, _ = coded_words(texts)
    out[:, 5] = np.log1p(counts) / 5
    if not len(codes):
        return out
    tags = _tags(words.to_pylist(), lexicon)
    strings = [t[0] for t in tags]
    weight = np.array([t[1] for t in tags])[codes]
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    blank = _BLANK[buf]
    before = np.cumsum(~blank & np.append(True, blank[:-1]))  # words that have begun
    first = np.zeros(len(codes) + 1, dtype=bool)
    first[0] = True
    first[before[buf == 10]] = True
    first[1:] |= np.array([t[2] for t in tags])[codes]
    clause = np.cumsum(first[:-1]) - 1
    starts = np.flatnonzero(first[:-1])
    ends = np.append(starts[1:], len(codes))
    owner = np.searchsorted(np.cumsum(counts), starts, side="right")
    hit = np.unique(clause[weight > 0])
    clauses = np.bincount(owner, minlength=len(texts))
    score, events = np.zeros(len(hit)), np.zeros((len(texts), len(EVENTS)))
    for i, c in enumerate(hit.tolist()):
        a, b = starts[c], ends[c]
        w, found = reading("".join(map(strings.__getitem__, codes[a:b].tolist())))
        score[i] = w + weight[a:b].sum()
        if score[i] > 0:
            np.add.at(events[owner[c]], found, 1)
    matched = score > 0
    mine, score = owner[hit[matched]], score[matched]
    total = np.bincount(mine, score, minlength=len(texts))
    np.maximum.at(out[:, 3], mine, score / 10)
    out[:, 1] = np.log1p(total)
    out[:, 2] = np.log1p(100 * total / (counts + 20)) / 2
    out[:, 4] = np.bincount(mine, minlength=len(texts)) / np.maximum(clauses, 1)
    out[:, 6:] = np.log1p(events * 100 / (counts[:, None] + 20))
    return out


def probability(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))


def fitted(x: np.ndarray, y: np.ndarray, steps: int = 40, precision: float = 0.3) -> np.ndarray:
    """Logistic weights that are likeliest under a normal prior around PRIOR, by Newton's method with halved steps."""
    w = PRIOR.copy()
    if len(set(y.tolist())) < 2:
        return w

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + precision / 2 * ((w - PRIOR) ** 2).sum())

    best = loss(w)
    for _ in range(steps):
        p = probability(x, w)
        gradient = x.T @ (p - y) + precision * (w - PRIOR)
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + precision * np.eye(len(w)), gradient)
        size = 1.0
        while size > 1e-6 and loss(w - size * move) > best:
            size /= 2
        w, old, best = w - size * move, best, min(best, loss(w - size * move))
        if old - best < 1e-9 * max(1.0, best):
            break
    return w


def _entries(word: str) -> list[str]:
    return [word, *[word[:n] + "*" for n in STEMS if n <= len(word)]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents and how many of their distinct words have each entry, by label; the empty entry has all words."""
    for batch in chunks(batches, limit=1_000_000):
        found: dict[str, list[int]] = {}
        for text, label in zip(raw(batch.column("text")), batch.column("toxic").to_pylist(), strict=True):
            own: dict[str, int] = {}
            distinct = {core(w) for w in set((text or b"").split())} - {""}
            for word in distinct:
                for e in _entries(word):
                    own[e] = own.get(e, 0) + 1
            own[""] = len(distinct)
            for e, n in own.items():
                row = found.setdefault(e, [0, 0, 0])
                row[label] += n
                row[2] += label
        rows = [(e, *row) for e, row in found.items()]
        kinds = [pa.string(), *[pa.int64()] * 3]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["entry", "clean", "toxic", "documents"])


def lexicon(sample: DataFrame) -> dict[str, float]:
    """Entries with their weights, from rows (text, toxic)."""
    counts = sample.select("text", "toxic").mapInArrow(_counted, "entry string, clean bigint, toxic bigint, documents bigint")
    counts = counts.groupBy("entry").agg(*[F.sum(c).alias(c) for c in ("clean", "toxic", "documents")])
    whole = counts.filter("entry = ''").select(F.col("clean").alias("_c"), F.col("toxic").alias("_t"))
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    share = (F.col("_t") + 1) / (F.col("_t") + F.col("_c") + 2)
    certain = 2 * (a * F.log(a / ((a + b) * share)) + b * F.log(b / ((a + b) * (1 - share))))
    # `whole` is a single row
    rated = counts.filter(F.col("documents") >= SUPPORT).filter("entry <> ''").join(F.broadcast(whole))
    rated = rated.select("entry", F.log(a / (F.col("_t") + 1) / (b / (F.col("_c") + 1))).alias("ratio"), certain.alias("certain"))
    listed = rated.filter((F.col("ratio") >= RATIO) & (F.col("certain") >= CERTAIN))
    # of entries with the same counts the most specific comes first: whole words, then long stems
    order = [F.desc("certain"), F.col("entry").endswith("*"), F.desc(F.length("entry")), F.col("entry")]
    out: dict[str, float] = {}
    inside: set[str] = set()  # all beginnings of what is in
    for r in listed.orderBy(*order).limit(LEXICON).collect():
        stem = r.entry.rstrip("*")
        if any(stem[:n] + "*" in out for n in STEMS) or stem in out or (r.entry.endswith("*") and stem in inside):
            continue
        out[r.entry] = float(r.ratio)
        inside.update(stem[:n] for n in STEMS)
    return out


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from labels (doc_id, toxic) and the texts of docs."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    some = known.filter(least(known, "doc_id", sample))
    cut = columns(docs, "doc_id", "text").join(F.broadcast(some), "doc_id")  # `sample` rows of two numbers
    kept = written(cut.groupBy("doc_id", "toxic").agg(F.max("text").alias("text")))
    words = lexicon(kept)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=2_000_000):
            x = clause_features([t or b"" for t in raw(batch.column("text"))], words).astype("<f8")
            rows = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), rows], names=["doc_id", "toxic", "x"])

    rows = kept.select("doc_id", "toxic", "text").mapInArrow(task, "doc_id bigint, toxic int, x binary").orderBy("doc_id").toArrow()
    discarded(kept)
    if not rows.num_rows:
        return Model()
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), "<f8").reshape(-1, WIDTH)
    return Model(words, fitted(x, rows.column("toxic").to_numpy().astype(np.float64)))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document."""
    words, weights = model.lexicon, model.weights

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=2_000_000):
            x = clause_features([t or b"" for t in raw(batch.column("text"))], words)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(probability(x, weights))], names=["doc_id", "score"])

    return columns(docs, "doc_id", "text").mapInArrow(task, "doc_id bigint, score double")


def op12_clause_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(fold(F.col("doc_id"), 5) != 0)
    out = scored(docs, learn(docs, labels))
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
