"""Event pages: what their elements and lines say, next tables, entities, and odd pages."""

import hashlib
import json

from pyspark.sql import functions as F

from windrose.operators import pages as P

NAMES = ["name", "raw_date_str", "start_date", "end_date", "status_text", "division_rounds", "location_raw", "city", "state", "country", "is_unscheduled_placeholder"]


def parse(spark, *htmls):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "event_id int, html string")
    return [r.asDict() for r in P.parse_pages(df).orderBy("event_id").collect()]


def page(*parts, head="<h1>A  Tier</h1>", date="<li class='x tournament-date'>Dates: 12-Apr-2025</li>", status='<td class="status">Official</td>'):
    return f"<html><head><title>t</title><script>var a = '<h2>MPO · x</h2><table><tr><th>Rd9</th></tr></table>';</script></head><body>{head}<ul>{date}</ul><table><tr>{status}</tr></table>{''.join(parts)}</body></html>"


TABLE = "<table><tr><th>Player</th><th>Rd1</th><th>Rd2</th></tr><tr><td>Rd7</td></tr></table>"


def test_elements(spark):
    (r,) = parse(spark, page("<h2>MA1 · Advanced (12)</h2>", TABLE, "<h2>FA1 &middot; Women&#39;s (4)</h2><p>x</p><div><table><tr><th>rd1</th></tr></table></div>", '<li class="tournament-location">Location: Austin, TX,  United States</li>'))
    assert r["name"] == "A Tier" and (r["start_date"], r["end_date"]) == ("2025-04-12", "2025-04-12") and r["status_text"] == "Official"
    assert r["division_rounds"] == {"MA1": 2, "FA1": 1} and r["parse_warnings"] == [] and not r["is_unscheduled_placeholder"]
    assert (r["location_raw"], r["city"], r["state"], r["country"]) == ("Austin, TX, United States", "Austin", "TX", "United States")
    said = json.dumps({n: r[n] for n in NAMES}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert r["idempotency_sha256"] == hashlib.sha256(said.encode()).hexdigest()


CASES = [
    ("<h3>MA1 A,Aú Advanced (50)</h3>" + TABLE, {"MA1": 2}),  # a broken separator: the first word is a code
    ("<h4>Ã Â· Men</h4>" + TABLE, {"Ã": 2}),
    ("<h2>Results of the day</h2>" + TABLE, {}),  # no code
    ("<h2>MPO · Open</h2><h2>FPO · Women</h2>" + TABLE, {"MPO": 2, "FPO": 2}),  # both have the same next table
    ("<h2>MPO · Open</h2>" + TABLE + "<h2>MPO · Open again</h2><table><tr><th>Rd12</th><th>Rd3</th></tr></table>", {"MPO": 12}),  # the last heading says it
    ("<h2>MPO · Open</h2><table>Rd4 <b>Rd5</b></table>", {"MPO": 5}),  # a table without rows is read whole
    ("<h2>MPO · Open</h2><table><tr><th>Round 1</th></tr></table>" + TABLE, {}),  # only the next table counts
    (TABLE + "<h2>MPO · Open</h2>", {}),  # no table follows
    ("<table><tr><td><h2>MPO · <i>Open</i></h2></td></tr></table><!-- <table><tr>Rd8</tr></table> -->" + TABLE, {"MPO": 2}),
    ("<h2>MPO · Open</h2><table><tr><th>xRd1</th><th>Rd2x</th><th>(RD3)</th></tr></table>", {"MPO": 3}),
    ("<h2></h2>" + TABLE, {}),
]


def test_next_tables(spark):
    got = parse(spark, *(page(body) for body, _ in CASES))
    assert [r["division_rounds"] for r in got] == [want for _, want in CASES]


def test_lines_say_what_elements_do_not(spark):
    a, b, c = parse(
        spark,
        "<h1>E</h1><p>Date: 03-May-2024 to 05-May-2024</p><div>Status Total Players</div><div>Event complete 72</div><p>Location</p><p>Paris, France</p>",
        "<h1>E</h1>\n<p>Dates: 30-Dec to 02-Jan-2025\nlocation:  Rome ,  IT</p><p>Status total players</p><p>Open</p><p>location</p><p>no</p>",
        "<p>Location: </p><p>date only</p>",
    )
    assert (a["start_date"], a["end_date"], a["status_text"], a["location_raw"], a["city"], a["country"]) == ("2024-05-03", "2024-05-05", "Event complete", "Paris, France", "Paris", "France")
    assert (b["start_date"], b["end_date"], b["status_text"], b["location_raw"], b["city"], b["state"]) == ("2024-12-30", "2025-01-02", "Open", "Rome , IT", "Rome", "IT")
    assert (c["start_date"], c["location_raw"]) == ("", "")


def test_placeholders_and_warnings(spark):
    rows = parse(spark, "<h1>Future</h1><div>This tournament has not been\n scheduled yet.</div>", page("<p>no results yet</p>"), "<p>scheduled? not <b>yet</b></p>", "", None, "<h1>a < b & c</h1>&nbsp;&#8594;&#x2192;&rarr;")
    assert [r["is_unscheduled_placeholder"] for r in rows] == [True, False, True, False, False, False]
    assert rows[0]["name"] == "Future" and rows[0]["parse_warnings"] == ["date_parse_failed:", "status_not_found", "division_rounds_empty"]
    assert rows[1]["parse_warnings"] == ["division_rounds_empty"] and rows[5]["name"] == "a < b & c"
    assert all(r["division_rounds"] == {} for r in rows)


def test_entities(spark):
    df = spark.createDataFrame([("&amp;lt; &lt;b&gt; &#65;&#x42;&#128512; &unknown; &",)], "t string")
    assert df.select(P.unescaped(F.col("t")).alias("t")).first()["t"] == "&lt; <b> AB\U0001f600 &unknown; &"


def test_repeated_pages_and_clashing_columns(spark):
    h = page("<h2>MPO · Open</h2>", TABLE)
    df = spark.createDataFrame([(1, h, "x"), (2, h, "y"), (1, h, "x")], "event_id int, html string, name string")
    got = P.parse_pages(df).collect()
    assert len(got) == 3 and {r["name"] for r in got} == {"A Tier"} and all(r["division_rounds"] == {"MPO": 2} for r in got)
    assert P.parse_pages(df.limit(0)).count() == 0
