"""Event pages as streams of tags and texts, in order; what a page says is found by windows over them.

A page is cut into tokens: tags, and the texts between them. Windows over a page's tokens carry what is open: the last heading, the
number of tables so far, the row of the table, list items and cells with their classes. So "the next table after a heading" is
the table whose number is one more than at the heading, wherever it stands. Each different page is read once.

Nothing here grows with the number of pages in one place: tokens are grouped by page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .normalize import PLACEHOLDERS, parse_date_range, split_location

#: comments, scripts and styles as one token each; tags; texts; a < that begins no tag
_TOKEN = r"(?s)<!--.*?-->|(?i:<(script|style)\b.*?</\1\s*>)|<[/!?A-Za-z][^>]*>|[^<]+|<"
_HEADINGS = ("h2", "h3", "h4")
#: Entities by name.
ENTITIES = {"nbsp": "\u00a0", "middot": "\u00b7", "ndash": "\u2013", "mdash": "\u2014", "rarr": "\u2192", "rsquo": "\u2019", "eacute": "\u00e9", "quot": '"', "apos": "'", "lt": "<", "gt": ">", "amp": "&"}
_CODE = r"^[A-Z]{1,4}\d{0,2}$"
_SEPARATOR = "\\s*(?:\u00c2?\u00b7)\\s*"


def unescaped(text: Column) -> Column:
    """Entities by number and by name become their characters; & itself comes last."""
    by_code = lambda t, pattern, base: F.aggregate(
        F.array_distinct(F.regexp_extract_all(t, F.lit(pattern), 1)), t,
        lambda acc, x: F.replace(acc, F.concat(F.lit("&#" if base == 10 else "&#x"), x, F.lit(";")), F.decode(F.unhex(F.lpad(F.conv(x, base, 16), 8, "0")), "UTF-32")),
    )
    out = by_code(by_code(text, r"&#(\d{1,6});", 10), r"&#x([0-9A-Fa-f]{1,5});", 16)
    for name, char in ENTITIES.items():
        out = F.replace(out, F.lit(f"&{name};"), F.lit(char))
    return F.when(text.contains("&"), out).otherwise(text)


def tokens(pages: DataFrame, html: str = "html", page: str = "page") -> DataFrame:
    """(page, pos, name, closing, classes, text) of each token of each different page; text is null for tags."""
    each = pages.select(page, F.coalesce(F.col(html), F.lit("")).alias("__html")).dropDuplicates([page])
    t = each.select(page, F.posexplode(F.regexp_extract_all("__html", F.lit(_TOKEN), F.lit(0))).alias("pos", "t"))
    tag = F.col("t").startswith("<") & (F.length("t") > 1)
    return t.select(
        page, "pos", F.when(tag, F.lower(F.regexp_extract("t", r"^</?([A-Za-z][A-Za-z0-9]*)", 1))).alias("name"), F.col("t").startswith("</").alias("closing"),
        F.when(tag, F.split(F.regexp_extract("t", r"(?i)\sclass\s*=\s*[\"']?([^\"'>]*)", 1), r"\s+")).alias("classes"), F.when(~tag, F.trim(F.regexp_replace(unescaped(F.col("t")), r"^\s+|\s+$", ""))).alias("text"),
    )


def _carried(t: DataFrame, page: str) -> DataFrame:
    """Texts with what is open around them."""
    so_far = Window.partitionBy(page).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = lambda *names: F.col("name").isin(*names) & ~F.col("closing")
    number = lambda *names: F.sum(opens(*names).cast("int")).over(so_far)
    inside = lambda *names: F.coalesce(F.last(F.when(F.col("name").isin(*names), ~F.col("closing")), ignorenulls=True).over(so_far), F.lit(False))
    its_classes = lambda name: F.last(F.when(opens(name), F.col("classes")), ignorenulls=True).over(so_far)
    d = t.withColumns(
        {
            "heading": number(*_HEADINGS), "in_heading": inside(*_HEADINGS), "h1": number("h1"), "in_h1": inside("h1"), "table": number("table"), "in_table": inside("table"),
            "item": number("li"), "in_item": inside("li"), "item_classes": its_classes("li"), "cell": number("td"), "in_cell": inside("td"), "cell_classes": its_classes("td"),
        }
    )
    of_table = Window.partitionBy(page, "table").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = lambda closing: F.sum(((F.col("name") == "tr") & (F.col("closing") == closing)).cast("int")).over(of_table)
    return d.withColumns({"row": rows(False), "rows_ended": rows(True)})


def _joined(condition: Column, separator: str = " ") -> Column:
    """Aggregate: the texts that meet a condition, in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(condition & (F.col("text") != ""), F.struct("pos", "text")))), lambda x: x["text"]), separator)


def _first_of(number: str, condition: Column) -> Column:
    """Aggregate: the texts of the first element that meets a condition."""
    found = F.array_sort(F.collect_list(F.when(condition & (F.col("text") != ""), F.struct("pos", F.col(number).alias("n"), "text"))))
    return F.array_join(F.transform(F.filter(found, lambda x: x["n"] == F.get(found, F.lit(0))["n"]), lambda x: x["text"]), " ")


def division_rounds(carried: DataFrame, page: str) -> DataFrame:
    """(page, division_rounds): the largest round in the header of the next table after each heading of a division."""
    texts = carried.where("text is not null")
    headings = texts.where("in_heading").groupBy(page, "heading").agg(_joined(F.lit(True)).alias("title"), (F.min("table") + 1).alias("table"))
    headers = carried.where("in_table").groupBy(page, "table").agg(
        F.max("row").alias("rows"), _joined((F.col("row") == 1) & (F.col("rows_ended") == 0) & F.col("text").isNotNull()).alias("first"), _joined(F.col("text").isNotNull()).alias("all")
    )
    title = S.collapse_spaces("title")
    word = F.element_at(F.split(title, " "), 1)
    code = F.when(title.rlike(_SEPARATOR), F.trim(F.element_at(F.split(title, _SEPARATOR, 2), 1))).when(word.rlike(_CODE), word)
    header = F.when(F.col("rows") > 0, F.col("first")).otherwise(F.col("all"))
    found = headings.join(headers, [page, "table"]).select(page, "heading", code.alias("code"), F.array_max(F.transform(F.regexp_extract_all(header, F.lit(r"(?i)\bRd(\d+)\b"), 1), lambda n: n.try_cast("int"))).alias("rounds"))
    last = found.where("code != '' and rounds is not null").groupBy(page, "code").agg(F.max_by("rounds", "heading").alias("rounds"))
    return last.groupBy(page).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "rounds")))).alias("division_rounds"))


def _after_colon(text: Column) -> Column:
    return F.when(F.instr(text, ":") > 0, F.trim(F.regexp_replace(text, r"^[^:]*:", ""))).otherwise(F.trim(text))


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with name, raw_date_str, start_date, end_date (ISO text), status_text, division_rounds (map), location_raw, city, state,
    country, is_unscheduled_placeholder, idempotency_sha256 (of the canonical JSON of these) and parse_warnings.

    Elements with classes come first; lines of the text that say the same follow. What a page does not say is empty.
    """
    page = "__page"
    keyed = pages.withColumn(page, F.sha2(F.coalesce(F.col(html), F.lit("")).cast("binary"), 256))
    carried = _carried(tokens(keyed, html, page), page)
    has = lambda classes, name: F.array_contains(F.coalesce(classes, F.array().cast("array<string>")), name)
    fields = carried.where("text is not null").groupBy(page).agg(
        _joined(F.col("in_h1") & (F.col("h1") == 1)).alias("name"), _first_of("item", F.col("in_item") & has("item_classes", "tournament-date")).alias("date_item"),
        _first_of("item", F.col("in_item") & has("item_classes", "tournament-location")).alias("place_item"), _first_of("cell", F.col("in_cell") & has("cell_classes", "status")).alias("status_cell"),
        _joined(F.lit(True), "\n").alias("lines"), _joined(F.lit(True)).alias("visible"),
    )
    lines = F.filter(F.transform(F.split("lines", r"[\r\n]+"), lambda x: S.collapse_spaces(x)), lambda x: x != "")
    d = keyed.select(page).distinct().join(fields, page, "left").join(division_rounds(carried, page), page, "left")
    d = d.fillna("", ["name", "date_item", "place_item", "status_cell", "lines", "visible"]).withColumn("l", lines)
    first = lambda condition: F.coalesce(F.get(F.filter("l", condition), F.lit(0)), F.lit(""))
    following = lambda word: F.coalesce(F.try_element_at("l", F.nullif(F.array_position(F.transform("l", lambda x: F.lower(x)), word), F.lit(0)).cast("int") + 1), F.lit(""))
    date = F.when(F.col("date_item") != "", _after_colon(F.col("date_item"))).otherwise(_after_colon(first(lambda x: x.rlike("(?i)^dates?:"))))
    status = F.when(F.col("status_cell") != "", F.col("status_cell")).otherwise(F.trim(F.regexp_replace(following("status total players"), r"\d+$", "")))
    said, below = first(lambda x: x.rlike(r"(?i)^location:\s*\S")), following("location")
    at = lambda line: F.nullif(F.array_position("l", line), F.lit(0))
    place = F.when((said != "") & ((below == "") | (at(said) <= F.array_position(F.transform("l", lambda x: F.lower(x)), "location"))), _after_colon(said)).otherwise(below)
    d = d.withColumns({"raw_date_str": date, "status_text": status, "location_raw": S.collapse_spaces(F.when(F.col("place_item") != "", _after_colon(F.col("place_item"))).otherwise(place)), "name": S.collapse_spaces("name")})
    d = d.withColumns({"__r": parse_date_range("raw_date_str"), "__p": split_location("location_raw"), "division_rounds": F.coalesce("division_rounds", F.create_map().cast("map<string,int>"))})
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    d = d.withColumns({"start_date": text("__r.start_date"), "end_date": text("__r.end_date"), "city": F.col("__p.city"), "state": F.col("__p.state"), "country": F.col("__p.country")})
    visible = S.collapse_spaces("visible")
    nothing = (F.col("start_date") == "") & (F.col("end_date") == "") & (F.size("division_rounds") == 0) & (F.col("status_text") == "")
    d = d.withColumn("is_unscheduled_placeholder", visible.rlike("(?i)" + "|".join(PLACEHOLDERS)) | (nothing & visible.rlike("(?i)scheduled") & visible.rlike("(?i)yet")))
    names = ["name", "raw_date_str", "start_date", "end_date", "status_text", "division_rounds", "location_raw", "city", "state", "country", "is_unscheduled_placeholder"]
    warnings = F.array(
        F.when(F.col("start_date") == "", F.concat(F.lit("date_parse_failed:"), "raw_date_str")), F.when(F.col("status_text") == "", "status_not_found"), F.when(F.size("division_rounds") == 0, "division_rounds_empty")
    )
    d = d.withColumns({"idempotency_sha256": S.canonical_sha256(names), "parse_warnings": F.filter(warnings, lambda w: w.isNotNull())})
    results = [*names, "idempotency_sha256", "parse_warnings"]
    kept = [c for c in pages.columns if c not in results]
    return keyed.select(page, *kept).join(d.select(page, *results), page).select(*kept, *results)
