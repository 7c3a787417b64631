"""Operator 2: quality rules of documents and of their hosts (DataFrame operations only).

Every document gets counts (words, repeated words, repeated lines, symbols) and
rule verdicts. Failures are then summed by host (column `source`); the hosts'
failure rates are shrunk towards the corpus by a beta prior whose two
parameters are fitted to the hosts' rates by moments (weighted by size), and
each host's verdict joins back to its documents:

* a host whose shrunk rate is over `HOST_REJECT` loses all its documents;
* a document that fails a rule at its full limit is rejected on any host, and
  on a suspect host (shrunk rate over `HOST_SUSPECT`) at 0.6 of the limit.

Nulls: a null text has no words and fails the base rule; null is a host of its
own. Empty tables give no rows; repeated rows are judged each; extra columns
are ignored by `features` and kept by `keep`. A rate or a count that equals its
limit passes. A very long text is one row, with some hundred bytes for each of
its words in arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.llm.common import BLANK_CHARS, checkpointed, columns, table, words

#: Window of the repeated-words rule, in words.
WINDOW = 5
HOST_REJECT, HOST_SUSPECT = 0.8, 0.4
#: Hosts are broadcast up to this count (a name and a rate each); beyond it the join shuffles.
BROADCAST_HOSTS = 50_000


def _window_hashes() -> Column:
    """A 64-bit hash of each run of WINDOW words, from the words' hashes in column _h."""
    starts = F.sequence(F.lit(0), F.size("_h") - F.lit(WINDOW))
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col("_h"), i + k) for k in range(WINDOW)]))
    return F.when(F.size("_h") >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>"))


def features(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and the rule columns.

    A word is repeated if it lies in a window found twice or more in its text.
    Only texts that repeat a window pay for sorting: equal windows are then
    neighbours, and the covered words are counted from the gaps between starts.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANK_CHARS, "")) > 0)
    tagged = F.sort_array(F.transform(F.col("_x"), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    # the starts of windows whose hash is also that of a neighbour in sorted order
    same = F.filter(
        F.transform(
            F.col("_s"),
            lambda s, i: F.when(
                (s["h"] == F.get(F.col("_s"), i - 1)["h"]) | (s["h"] == F.get(F.col("_s"), i + 1)["h"]), s["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    covered = F.aggregate(
        F.col("_p"),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    repeats = F.size(F.array_distinct("_x")) < F.size("_x")
    out = (
        docs.withColumn("_w", words(F.col("text"))).withColumn("_h", F.transform("_w", lambda x: F.xxhash64(x))).withColumn("_x", _window_hashes())
        .withColumn("_s", F.when(repeats, tagged))
        .withColumn("_p", F.when(F.col("_s").isNotNull(), F.sort_array(same)))
        .withColumn("_l", lines)
        .withColumn("n_words", F.size("_w").cast("bigint"))
        .withColumn("word_chars", F.length(F.translate(text, BLANK_CHARS, "")).cast("bigint"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("bigint"))
        .withColumn("n_lines", F.size("_l").cast("bigint"))
        .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"))
        .withColumn("n_repeat_words", F.when(F.col("_p").isNull(), F.lit(0)).otherwise(covered).cast("bigint"))
        .drop("_w", "_h", "_x", "_s", "_p", "_l")
    )
    made = [c for c in ruled(out).columns if c not in docs.columns]
    # a generated row is a barrier: filters on the counts aren't rewritten into filters on the text, which would count many times
    return ruled(out).select(*docs.columns, F.inline(F.array(F.struct(*made))))


def ruled(df: DataFrame) -> DataFrame:
    """Verdicts over the counts: base_failed, rules failed at the full and at the tightened limits, failed."""
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    def count(share: float) -> Column:
        """Rules failed when only this share of each limit is allowed."""
        rules = [
            100 * F.col("n_symbols") > 10 * share * F.col("word_chars"),
            100 * F.col("n_dup_lines") > 30 * share * F.col("n_lines"),
            F.col("word_chars") > 20 * share * F.col("n_words"),
        ]
        return sum((F.when(r, F.lit(1)).otherwise(F.lit(0)) for r in rules), F.lit(0))

    return (
        df.withColumn("base_failed", base).withColumn("n_hard", count(1.0)).withColumn("n_soft", count(0.6))
        .withColumn("failed", base | (F.col("n_hard") > 0))
    )


def host_rates(feats: DataFrame) -> DataFrame:
    """source, n, k and the shrunk failure rate of each host.

    With mean m and variance v of the hosts' rates (weighted by documents, less
    the mean binomial noise), the prior's weight is s = m(1-m)/v - 1, and the
    rate is (k + m s) / (n + s). No spread beyond noise: the prior wins with
    the weight of the whole corpus.
    """
    hosts = feats.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("int")).alias("k"))
    rate = F.col("k") / F.col("n")
    total = hosts.agg(F.sum("n").alias("_n"), F.sum("k").alias("_k"), F.count(F.lit(1)).alias("_h"), F.sum(F.col("k") * rate).alias("_kk"))
    mean = F.col("_k") / F.col("_n")
    spread = F.col("_kk") / F.col("_n") - mean * mean - F.col("_h") * mean * (1 - mean) / F.col("_n")
    prior = F.when((spread > 1e-12) & (mean > 0) & (mean < 1), F.least(F.greatest(mean * (1 - mean) / spread - 1, F.lit(1.0)), F.col("_n"))).otherwise(F.col("_n"))
    # `total` is a single row of an aggregate without keys
    return hosts.join(F.broadcast(total)).select("source", "n", "k", ((F.col("k") + mean * prior) / (F.col("n") + prior)).alias("host_rate"))


def verdict(feats: DataFrame, hosts: DataFrame, host_count: int) -> DataFrame:
    """feats with host_rate and kept."""
    side = hosts.select(F.col("source").alias("_source"), "host_rate")
    if host_count <= BROADCAST_HOSTS:
        side = F.broadcast(side)
    joined = feats.join(side, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    rejected = (F.col("n_hard") > 0) | (F.col("host_rate") > HOST_REJECT) | ((F.col("host_rate") > HOST_SUSPECT) & (F.col("n_soft") > 0))
    kept = ~F.col("base_failed") & ~F.coalesce(rejected, F.lit(False))
    return joined.withColumn("kept", kept)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, source, the counts and the verdicts of every document.

    The narrow counts are checkpointed, so the texts are read once for both
    the hosts' sums and the documents' verdicts.
    """
    feats = checkpointed(features(columns(docs, "doc_id", "text", "source")).drop("text"))
    hosts = checkpointed(host_rates(feats))
    return verdict(feats, hosts, hosts.count())


def keep(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns only.

    The hosts' verdicts come from a first pass; the counts are made again in a
    second one. Only suspect hosts matter there, so no text is shuffled unless
    there are over `BROADCAST_HOSTS` of those.
    """
    first = features(columns(docs, "text", "source")).drop("text")
    hosts = checkpointed(host_rates(first).filter(F.col("host_rate") > HOST_SUSPECT))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *columns_of(docs))
    judged = verdict(features(own), hosts, hosts.count()).filter("kept")
    return judged.select("_row.*")


def columns_of(docs: DataFrame) -> list[Column]:
    return [(F.col(f"`{n}`") if n in docs.columns else F.lit(None)).cast("string").alias(n) for n in ("text", "source")]


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("host_rate", 6).alias("host_rate")
    )
