"""Every registered query against its SQL text, and the shape of plans."""

import math
import os

import pandas as pd
import pytest

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cells(frame):
    def cell(v):
        if v is None or v is pd.NA or v != v:
            return ""
        if isinstance(v, bool):
            return str(v)
        return f"{float(v):.9g}" if isinstance(v, int | float) and not isinstance(v, bool) and math.isfinite(v) else str(v)

    return sorted(tuple(cell(getattr(v, "item", lambda v=v: v)()) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_queries_match_sql(spark):
    import duckdb

    from placeflow.plans import registry

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    wrong = []
    for name, make in registry.QUERIES.items():
        got, want = make(spark, DATA).toPandas(), con.sql(registry.ORACLES[name]).df()
        for f in (got, want):
            for c in f.columns:
                if f[c].dtype.kind == "M":
                    f[c] = f[c].astype("datetime64[us]")
        if sorted(got.columns) != sorted(want.columns) or cells(got) != cells(want):
            wrong.append(name)
    assert not wrong


def test_titles_match_sql_on_odd_pages(spark, tmp_path):
    import duckdb

    from placeflow.plans import registry

    titles = ["a &amp;&amp;&amp b&amp", "token = &quot;0b96a8c8d&quot;", "&#39;x&#39; &lt;b&gt; &amp;lt;", "  a  b\t", "\n a\n", "", " ", "a<b>c</b>", "<!-- x -->y", "é &eacute; 𝄞", "a</title><title>b"]
    pages = [f"<html><head><title>{t}</title></head><body><p>x</p></body></html>" for t in titles]
    pages += [None, "", "<p>no title</p>", "<title>never closed", "<title lang='en'>a</title>", "<TITLE>a</TITLE>", "<!-- <title>old</title> --><title>new</title>"]
    path = f"{tmp_path}/pages.parquet"
    spark.createDataFrame(list(enumerate(pages)), "page_id bigint, html string").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{path}/*.parquet'")
    want = sorted(con.sql(registry.ORACLES["html_title"]).fetchall())
    assert sorted(map(tuple, registry.html_title(spark, str(tmp_path)).collect())) == want and want[1][1] == "token = &quot;0b96a8c8d&quot;"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_plans(spark, capsys):
    from placeflow.plans import registry

    def plan(name):
        registry.QUERIES[name](spark, DATA).explain("formatted")
        return capsys.readouterr().out

    assert "WindowGroupLimit" in plan("completeness_dedup")
    for name in registry.QUERIES:
        if not name.startswith("html_") and name not in ("explode_outer_links", "enrichment_outcomes", "review_rows", "review_details", "medical_sections", "main_links", "detail_fields", "search_positions"):
            assert "ArrowEvalPython" not in plan(name), name
    assert "PushedFilters: [IsNotNull(l_linenumber), LessThanOrEqual(l_linenumber,2)]" in plan("page_cutoff")
    assert "ReadSchema: struct<c_custkey:bigint>" in plan("membership_semi_join")


def test_entry_point():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 70
