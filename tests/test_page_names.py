"""The names of event pages, in the query and in its SQL."""

import duckdb

import __spark_entry__ as entry

NAMES = [
    'token = &quot;77&quot;', "Women&#39;s &amp;lt; &lt;b&gt;", "A&nbsp;B &middot; C &ndash; D", "x &#x42;&#128512; &unknown; & &am", "two <b>words</b>\n of\x0b it", "", "half &#55296; &#xDFFF; pair",
]


def test_names_match_the_sql(spark, tmp_path):
    pages = [(i, f"<html><body><h1>{name}</h1><p>&quot;</p></body></html>") for i, name in enumerate(NAMES)]
    spark.createDataFrame(pages, "page_id long, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r["name"] for r in entry.queries()["b43_b44_event_pages"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = {r[0]: r[1] for r in con.execute(f"SELECT page_id, name FROM ({entry.oracle_sql()['b43_b44_event_pages']})").fetchall()}
    assert got == want
    assert got[0] == 'token = "77"' and got[1] == "Women's &lt; <b>"
