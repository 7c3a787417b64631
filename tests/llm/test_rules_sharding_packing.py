import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeflow.llm import packing, quality_rules, sharding
from placeflow.llm.tokens import coded_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            covered |= set(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_rule_counts(docs, rows):
    got = Counter(tuple(r) for r in quality_rules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect())
    want = Counter()
    for r in rows:
        c = counts(r[1])
        want[(r[0], *c, c[0] < 10 or 100 * c[4] > 20 * c[0])] += 1
    assert got == want


def test_hosts_shrink_and_decide(spark):
    good, bad = "some plain words that make one fine line of text for reading here", "# $ " * 12
    rows = [(i, bad + f" w{i} w w2 w3 w4", "h1") for i in range(40)] + [(100 + i, good + f" {i}", "h2") for i in range(60)] + [(200, good, "h1"), (201, good, "h3"), (202, good, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    judged = {r.doc_id: r for r in quality_rules.judge(df).collect()}
    rate = {r.source: r.host_rate for r in judged.values()}
    assert rate["h1"] > 0.8 > 0.5 > rate["h2"] and 0 < rate["h3"] < 40 / 41 and None in rate
    assert not judged[200].kept and judged[201].kept and judged[202].kept and all(judged[100 + i].kept for i in range(60))
    kept = {r.doc_id for r in quality_rules.keep(df).collect()}
    assert kept == {k for k, r in judged.items() if r.kept}


def test_no_spread_between_hosts(spark):
    df = spark.createDataFrame([(i, "ten plain words are enough to pass the base rule here", f"h{i % 2}") for i in range(8)], "doc_id bigint, text string, source string")
    assert {(r.host_rate, r.kept) for r in quality_rules.judge(df).collect()} == {(0.0, True)}


def test_rules_edges(none, docs, clashing):
    assert quality_rules.judge(none).count() == 0 and quality_rules.keep(none).count() == 0
    assert quality_rules.keep(clashing).columns == clashing.columns
    assert quality_rules.keep(clashing).count() == quality_rules.keep(docs).count() == quality_rules.judge(docs).filter("kept").count()


@pytest.mark.parametrize("count", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_is_one_and_can_be_undone(count):
    p = sharding.permute(np.arange(count), count)
    assert sorted(p) == list(range(count))
    assert (sharding.permute(p, count, inverse=True) == np.arange(count)).all()


def test_shards(docs, rows, none, clashing):
    out = sharding.shard(docs).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(16))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shard(docs.repartition(7, "lang")).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))
    assert sharding.shard(none).count() == 0 and sharding.shard(clashing).count() == len(rows)
    assert sharding.shard(docs.limit(1)).count() == 1


def test_packing_holds_every_id_once(docs, rows, none, clashing):
    path = packing.tokenizer_path()
    out = packing.pack(docs, path).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    want = {(r[0], r[1]): np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 1], dtype="<u4") for r in rows}
    by, place, loss = defaultdict(list), defaultdict(list), Counter()
    for r in out:
        place[r.sequence_id].append((r.offset, r.length))
        by[r.doc_id].append(r)
        loss[r.sequence_id] += r.n_loss
    assert max(loss.values()) <= packing.LOSS
    for seq in place.values():
        at = 0
        for offset, length in sorted(seq):
            assert offset == at and length > 0
            at += length
        assert at <= 2048 and len(seq) <= packing.SEGMENTS
    for (key, _), ids in want.items():
        if sum(k == key for k, _ in want) == 1:
            got = sorted(by[key], key=lambda r: r.start)
            copies = sum(r[0] == key for r in rows)
            assert sum(r.length for r in got) == copies * len(ids)
            for r in got:
                assert r.doc_tokens == len(ids) and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert packing.pack(none, path).count() == 0 and packing.pack(clashing, path).count() >= len(rows)
    pad = packing.padding(packing.pack(docs, path)).first()
    assert pad.padding < 0.02 * pad.tokens + 3 * 2048


def test_vector_limits_with_loss_masks():
    r = np.random.default_rng(3)
    p = packing.Packer(tokens=256, segments=6, loss=100, pool=40)
    items = [(i, r.integers(0, 99, n).astype("<u4"), (r.random(n) < 0.6).astype(np.int64)) for i, n in enumerate(r.integers(1, 400, 300))]
    placed = [x for k, ids, m in items for x in p.add(k, ids, m)] + list(p.close())
    seqs, docs_ = defaultdict(list), defaultdict(list)
    for key, start, ids, whole, number, offset, loss in placed:
        assert loss == items[key][2][start : start + len(ids)].sum()
        seqs[number].append((offset, len(ids), int(items[key][2][start : start + len(ids)].sum())))
        docs_[key].append((start, len(ids)))
    for s in seqs.values():
        assert sum(n for _, n, _ in s) <= 256 and len(s) <= 6 and sum(x for _, _, x in s) <= 100
    for key, parts in docs_.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == len(items[key][1])
    assert len(docs_) == 300


def test_prompts_bear_no_loss_and_fill_sequences(spark):
    """Long texts that bear loss in nearly all tokens, and short ones with long prompts: all three limits hold and the loss limit binds."""
    path = packing.tokenizer_path()
    rows = [(i, "ask " * 5 + "\n" + "word " * 6000) for i in range(4)] + [(10 + i, "\n \n" + "what is it " * 40 + "\nyes it is") for i in range(40)] + [(99, "one line only")]
    out = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), path, with_ids=True).toPandas()
    plain = packing.WordIds(path)
    prompt = {k: len(next(plain([t.lstrip().split("\n")[0].encode()]))) - 1 if "\n" in t.strip() else 0 for k, t in rows}
    for r in out.itertuples():
        assert r.n_loss == sum(r.start + j >= prompt[r.doc_id] for j in range(r.length)) and len(r.ids) == r.length
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    sums = out.groupby("sequence_id")[["length", "n_loss"]].sum()
    assert sums.length.max() <= 2048 and sums.n_loss.max() == packing.LOSS
    assert ((sums.n_loss == packing.LOSS) & (sums.length == 2048)).sum() >= 5


def test_turns_bear_loss_by_role(spark):
    turns = [(1, "hello you there", "user"), (1, "hello to you", "assistant"), (2, "what", "user"), (2, "that\nand this", None)]
    df = spark.createDataFrame(turns, "doc_id bigint, text string, role string").withColumn("bears", F.col("role") == "assistant")
    out = packing.pack(df, packing.tokenizer_path(), loss_column="bears").toPandas()
    assert sorted(zip(out.doc_id, out.length, out.n_loss, strict=True)) == sorted([(1, 4, 0), (1, 4, 4), (2, 2, 0), (2, 4, 3)])


def test_words_and_prompts_are_coded():
    texts = [b"", b" \n", b"a b\nc", b"\n\x0b x\ny x\n", b"last line\n", "é\u00a0 z".encode()]
    words, codes, counts, prompts, whole = coded_words(texts)
    assert [words[c].as_py() for c in codes] == [w for t in texts for w in t.split()]
    assert counts.tolist() == [len(t.split()) for t in texts] and prompts.tolist() == [0, 0, 2, 1, 0, 0]
    assert [len(x) for x in coded_words([])] == [0, 0, 0, 0, 0] and whole.all()
    words, codes, counts, prompts, whole = coded_words([b"Ab12.,x\nIt's", "ÉÀ×é Été.".encode()], parts=True)
    assert [words[c].as_py().decode() for c in codes] == ["ab", "1", "2", ".,", "x", "It's", "ÉÀ×é", "été", "."]
    assert counts.tolist() == [6, 3] and prompts.tolist() == [5, 0] and sorted(words[i].as_py().decode() for i in np.flatnonzero(whole)) == ["It's", "ÉÀ×é"]


def test_words_are_encoded_as_in_whole_texts():
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    texts = ["it's we'll don ' t 0 00 a0b", "é ́x", " foo bar", "日本 語 123 45a", "İstanbul ǅ ﬁ", "<|startoftext|> y", "", " \n", "\U0001f600á ٠", "A1B22.c,,D É.é Ünï-code x\x7f\x1fy '' 's ''s a's 's1 .'s ÿß ÀÞ Ÿ e\u0301 .\u0338 1\u0301 Ã\u0303", "\xa0a\x85b\u2028c"]
    for s, ids in zip(texts, packing.WordIds(path)([s.encode() for s in texts]), strict=True):
        assert ids.tolist() == [*t.encode(s, add_special_tokens=False).ids, 1]
