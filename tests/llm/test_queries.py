"""The registered queries on the driver's smallest tables."""

import os

import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


def test_queries_match_sql(spark):
    import duckdb

    from placeflow.llm import queries

    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    for name, sql in queries.ORACLES.items():
        got = queries.QUERIES[name](spark, DATA).toPandas()
        by = "doc_id" if "doc_id" in got else ["part", "filter_order", "step"]
        got = got.sort_values(by).reset_index(drop=True)
        want = con.sql(sql).df()[list(got.columns)].sort_values(by).reset_index(drop=True)
        assert (got == want).all().all(), name


def test_every_query_has_a_row_for_each_document(spark):
    import __spark_entry__
    from placeflow.llm import queries

    n = spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert set(queries.QUERIES) <= set(__spark_entry__.queries()) and "pipeline" in __spark_entry__.queries()
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, len(queries.QUERIES) + 1))
    for name in ("op1_byte_gru", "op3_jpeg_media", "op4_feistel_shards", "op6_piece_lattice", "op7_line_crf", "op8_brown_classes", "op11_harmonic_runs", "op12_clause_grammar"):
        assert queries.QUERIES[name](spark, DATA).count() == n, name


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, DATA).cache()
        assert docs.columns == columns
        kept[name] = {r.quality: r["count"] for r in docs.join(labels, "doc_id").groupBy("quality").count().collect()}
    assert kept["quality_rules"][1] >= 0.9 * labels.filter("quality = 1").count()
    assert kept["quality_classifier"].get(0, 0) <= 1 and kept["quality_classifier"][1] >= 0.95 * kept["quality_rules"][1]
    assert corpus_pipeline.run(spark, DATA).agg({"doc_tokens": "count"}).first()[0] > 0


def test_pipeline_matches_brute_force_on_odd_tables(spark, tmp_path, docs, rows, none, clashing):
    """Nulls, repeated rows, ties, clashing columns and an empty table, from end to end."""
    from collections import Counter

    import corpus_pipeline
    from placeflow.llm import packing
    from tests.llm.test_dedup import brute_components, brute_spans

    labels = spark.createDataFrame([(r[0], int("BUY" not in (r[1] or ""))) for r in rows if r[0] is not None and r[0] < 1000], "doc_id bigint, quality int")
    for name, table in (("odd", clashing), ("none", none)):
        where = str(tmp_path / name)
        table.write.parquet(f"{where}/documents.parquet")
        labels.write.parquet(f"{where}/labels.parquet")
        now, columns = spark.read.parquet(f"{where}/documents.parquet"), table.columns
        steps = []
        for _, stage in corpus_pipeline.STAGES[:4]:
            now = stage(spark, now, where).checkpoint()
            assert now.columns == columns
            steps.append(Counter((r.doc_id, r.text) for r in now.select("doc_id", "text").collect()))
        rules, classified, linked, stripped = steps
        assert not rules - Counter((r[0], r[1]) for r in rows) and not classified - rules
        assert all(len((t or "").split()) >= 10 and "BUY" not in t for _, t in rules)
        parts = brute_components(list(classified.elements()), 5)
        assert linked == Counter(r for r in classified.elements() if r[0] is None or parts[r[0]] == r[0])
        want = Counter((i, n - gone) for i, n, gone, _ in brute_spans(list(linked.elements())).elements())
        assert Counter((i, len((t or "").encode().split())) for i, t in stripped.elements()) == want
        tokens = Counter()
        for r in corpus_pipeline.run(spark, where).collect():
            tokens[r.doc_id] += r.length
        ids = packing.WordIds(packing.tokenizer_path())
        assert tokens == sum((Counter({i: len(next(ids([(t or "").encode()])))}) for i, t in stripped.elements()), Counter())
        assert (name == "none") == (not rules)
