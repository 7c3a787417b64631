import random

import pytest

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus(n=120, seed=1):
    """Documents with copies, near copies, shared passages, junk and a hot source."""
    r = random.Random(seed)
    words = {"en": "the of and thing house river stone bird".split(), "de": "der die und nicht straße wären schön".split(), "fr": "le la été où garçon naïf dans".split()}
    langs = list(words)
    passage = " ".join(r.choice(words["en"]) + str(i) for i in range(30))
    rows = []
    for i in range(n):
        lang = r.choice(langs)
        body = [r.choice(words[lang]) + r.choice(["", "", ".", "a", "er"]) + (str(r.randrange(40)) if r.random() < 0.5 else "") for _ in range(r.choice([3, 12, 40, 90]))]
        if i % 7 == 3:
            body[len(body) // 2 : 0] = passage.split()
        text = " ".join(w + ("\n" if r.random() < 0.08 else "") for w in body)
        if i % 10 == 4 and rows:
            _, text, lang, *_ = r.choice(rows)
        if i % 10 == 6 and rows:
            _, old, lang, *_ = r.choice(rows)
            old = old.split(" ")
            old[r.randrange(len(old))] = "changed"
            text = " ".join(old)
        if i % 12 == 5:
            text = "\n".join(["BUY NOW!! $$$ ### ***"] * 6)
        rows.append((i, text, lang, "host0" if i % 3 else f"host{i % 5}", len(text)))
    return rows


EDGE = [
    (1001, None, None, None, None), (1002, "", "en", "", 0), (1003, " \n\t ", "en", "host0", 4), (1004, "one", "en", "host0", 3), (1004, "one", "en", "host0", 3),
    (None, "a row without an id but with some words in it all the same", "en", "host1", 50), (None, None, None, None, None),
    (1005, "word " * 9000, "en", "host0", 45000), (1006, "ünïcode 　   日本語 \U0001f600 x\x00y ▁ <|endoftext|>", None, "host2", 30), (1007, "x" * 5000, "en", "host0", 5000),
]


@pytest.fixture(scope="session")
def rows():
    return corpus() + EDGE


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, KIND).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same rows with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ["n_words", "kept", "_w", "_row", "component", "a", "b", "band", "spans", "_cover", "score", "row_number", "ids", "segment", "n", "tag", "failed"]
    return docs.withColumns({n: F.lit("x") for n in names})
