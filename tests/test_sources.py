"""Readers, page extraction and sinks on small hand-written files."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F, types as T

from shelfmark import scratch
from shelfmark.functions import dates, text, urls
from shelfmark.plans import runs
from shelfmark import queries as registry
from shelfmark.sources import api_pages, checks, files, jobs, markup, page_blocks, sinks

BOM = "﻿"


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def write(path, content, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as handle:
        handle.write(content)
    return str(path)


def test_csv_with_bom_line_breaks_quotes_and_blanks(spark, tmp_path):
    path = write(f"{tmp_path}/r.csv", BOM + 'buyer,title,url\nAnn,"one\ntwo, ""x""",u1\nBob, ,\n')
    frame = files.read_csv(spark, path, ["buyer", "title", "url"], multiline=True)
    assert rows(frame, "buyer", "title", "url", "source_file") == [
        ("Ann", 'one\ntwo, "x"', "u1", "r.csv"), ("Bob", None, None, "r.csv")]
    assert files.read_csv(spark, path, ["buyer", "title", "url"]).count() == 3  # line by line


def test_csv_arrival_follows_the_file(spark, tmp_path):
    path = write(f"{tmp_path}/a.csv", "n\n" + "".join(f"{i}\n" for i in range(50)))
    frame = files.read_csv(spark, path, ["n"])
    assert [r["n"] for r in frame.orderBy("arrival").collect()] == [str(i) for i in range(50)]


def test_csv_without_header_ragged_columns(spark, tmp_path):
    path = write(f"{tmp_path}/u.csv", "https://a/1?x=1,\nhttps://a/2\n")
    frame = files.read_csv(spark, path, ["url", "rest"], header=False)
    assert rows(frame, "url", "rest") == [("https://a/1?x=1", None), ("https://a/2", None)]


def test_drifted_csv_groups(spark, tmp_path):
    one = write(f"{tmp_path}/1/a.csv", "id,name\n1,x\n")
    two = write(f"{tmp_path}/2/b.csv", "name,extra,id\ny,e,2\n")
    frame = files.read_csv_drifted(spark, [(one, ["id", "name"]), (two, ["name", "extra", "id"])])
    assert rows(frame, "id", "name", "extra", "source_file") == [
        ("1", "x", None, "a.csv"), ("2", "y", "e", "b.csv")]


def test_csv_of_unknown_encoding(spark, tmp_path):
    content = 'id;name\n1;"café €\n2"\n2;\n3;plain\n'
    for encoding in ("utf-8-sig", "utf-8", "cp1252"):
        write(f"{tmp_path}/{encoding}.csv", content, encoding)
    with open(f"{tmp_path}/latin.csv", "wb") as handle:  # 0x81 has no meaning in cp1252
        handle.write(b"id;name\n1;caf\xe9 \x80\x81\n")
    frame = files.read_csv_any_encoding(spark, f"{tmp_path}/*.csv", ["id", "name"], multiline=True,
                                        delimiter=";")
    same = [("1", "café €\n2"), ("2", None), ("3", "plain")]
    assert rows(frame, "source_file", "id", "name") == sorted(
        [(f"{e}.csv", *r) for e in ("utf-8-sig", "utf-8", "cp1252") for r in same]
        + [("latin.csv", "1", "café \x80\x81")], key=repr)


def test_typed_csv(spark, tmp_path):
    path = write(f"{tmp_path}/t.csv", "id,title\n1,a\n,b\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("title", T.StringType())])
    assert rows(files.read_typed_csv(spark, path, schema), "id", "title") == [(1, "a"), (None, "b")]


def image(n):
    return f"https://img.example/a,{n}/full.{n}.jpg"


def test_url_lines(spark, tmp_path):
    pattern = r"https://img\.example/\S+?full\.\S+?\.jpg"
    first = write(f"{tmp_path}/1.csv", BOM + f"listing_id,images\n7,{image(1)},{image(2)},{image(1)}\n"
                  f"x9,{image(1)}\n\n8,none\nhttps://s/listing/9/t?x=1,{image(5)}\n7,{image(3)},{image(2)}\n")
    os.utime(first, (1000, 1000))
    second = write(f"{tmp_path}/0.csv", f"7,{image(4)}\n9,{image(6)}\n9,{image(7)}\n10,{image(8)}\n")
    os.utime(second, (2000, 2000))
    merged = files.merge_url_lines(files.read_url_lines(spark, [first, second], pattern))
    assert rows(merged, "listing_id", "position", "url") == [
        ("10", 1, image(8)), ("7", 1, image(1)), ("7", 2, image(2)), ("7", 3, image(3)),
        ("9", 1, image(6)), ("9", 2, image(7))]


def test_url_lines_tie_keeps_the_older_file(spark, tmp_path):
    pattern = r"https://img\.example/\S+?full\.\S+?\.jpg"
    newer, older = (write(f"{tmp_path}/{n}.csv", f"7,{image(n)}\n") for n in (1, 2))
    os.utime(newer, (2000, 2000))
    os.utime(older, (1000, 1000))
    merged = files.merge_url_lines(files.read_url_lines(spark, [newer, older], pattern))
    assert rows(merged, "url") == [(image(2),)]


def test_state_files(spark, tmp_path):
    ids = write(f"{tmp_path}/ids.json", json.dumps(["1", "2"], indent=1))
    cards = write(f"{tmp_path}/map.json", json.dumps({"1": "c1", "2": "c2"}, indent=1))
    assert rows(files.read_id_list(spark, ids, whole_file=True), "listing_id") == [("1",), ("2",)]
    assert rows(files.read_id_map(spark, cards, whole_file=True), "listing_id", "card_id") == [
        ("1", "c1"), ("2", "c2")]
    sinks.write_id_list(spark.range(3).select(F.col("id").alias("listing_id")), f"{tmp_path}/out")
    assert spark.read.json(f"{tmp_path}/out").count() == 3


def test_folder_scans(spark, tmp_path):
    for name in ("shop a/1/image_10.jpg", "shop a/1/image_2.PNG", "shop a/1/note.txt",
                 "shop b/2/cover.webp"):
        write(f"{tmp_path}/images/{name}", "x")
    got = files.scan_images(spark, f"{tmp_path}/images").select(
        "listing_id", "position", F.element_at(F.split("path", "/"), -1).alias("file"))
    assert rows(got, "listing_id", "position", "file") == [
        ("1", 1, "image_2.PNG"), ("1", 2, "image_10.jpg"), ("2", 1, "cover.webp")]
    for name in ("5_art.png", "5_art_back.png", "6_art_back.png", "7_art.jpg", "8.png"):
        write(f"{tmp_path}/art/{name}", "x")
    art = files.scan_art(spark, f"{tmp_path}/art").select("listing_id", *[
        F.element_at(F.split(c, "/"), -1).alias(c) for c in ("front", "back")])
    assert rows(art, "listing_id", "front", "back") == [
        ("5", "5_art.png", "5_art_back.png"), ("7", "7_art.jpg", None)]


def test_csv_sink_and_wide_images(spark, tmp_path):
    frame = spark.createDataFrame([("1", ["u1", "u2"]), ("2", []), (None, ["u3"])],
                                  "id string, images array<string>")
    wide = sinks.widen(frame)
    assert wide.columns == ["id", "image_1", "image_2"]
    sinks.write_csv(wide, f"{tmp_path}/out")
    back = files.read_csv(spark, f"{tmp_path}/out", wide.columns)
    assert rows(sinks.gather(back.drop("arrival", "source_file")), "id", "images") == [
        ("1", ["u1", "u2"]), ("2", []), (None, ["u3"])]


def test_replace_then_append_table(spark, tmp_path):
    frame = spark.range(3)
    sinks.replace_table(frame, "shelfmark_jobs", f"{tmp_path}/jobs")
    sinks.append_table(frame, "shelfmark_jobs")
    try:
        assert spark.table("shelfmark_jobs").count() == 6
        assert spark.table("shelfmark_jobs").columns == ["id"]  # no extra index column
    finally:
        spark.sql("DROP TABLE shelfmark_jobs")


def test_write_by_shop_and_file_names(spark, tmp_path):
    frame = spark.createDataFrame([("s1", "9", 1, "https://h/a.gif?x"), ("s2", "9", 2, "https://h/b")],
                                  "shop string, listing string, n int, url string")
    named = sinks.image_files(frame, "shop", "listing", F.col("n"), F.col("url"))
    assert rows(named, "file_name") == [("image_1.gif",), ("image_2.jpg",)]
    sinks.write_by_shop(named, f"{tmp_path}/by", "shop")
    assert sorted(d for d in os.listdir(f"{tmp_path}/by") if d.startswith("shop=")) == [
        "shop=s1", "shop=s2"]


def test_api_images_may_be_array_or_text(spark):
    frame = spark.createDataFrame([
        ('[{"url_170x135":"s","url":"b"}]', None), ('[{"url_fullxfull":"f"}]', "i"), ('["p"]', None),
        ("[]", "i"), (None, "i"), ("https://x", "i")], "images string, icon string")
    got = [r[0] for r in frame.select(api_pages.image_of(F.col("images"), F.col("icon"))).collect()]
    assert got == ["s", "f", "p", "i", "i", "i"]    # a bare text is no list of images


def test_api_pages_from_json(spark, tmp_path):
    page = {"shop_details": {"shop_name": "S", "shop_id": 5, "revenue": "Please upgrade"},
            "results": [{"listing_id": 1, "title": "Please upgrade", "tags": [" a", ""],
                         "Images": "https://x"}], "total_pages": 1}
    path = write(f"{tmp_path}/p.json", json.dumps(page) + "\n" + json.dumps({"results": []}))
    schema = ("shop_details struct<shop_name:string,shop_id:bigint,revenue:string>, results "
              "array<struct<listing_id:bigint,title:string,tags:array<string>,Images:string>>")
    pages = spark.read.schema(schema).json(path)
    assert rows(api_pages.shops(pages), "shop_name", "shop_id", "shop_revenue") == [("S", 5, None)]
    listings = api_pages.shop_listings(pages, F.col("shop_details.shop_name"))
    assert rows(listings, "shop_name", "listing_id", "title", "tags", "image_url") == [
        ("S", 1, None, "a", "https://x")]
    assert listings.columns[:3] == ["shop_name", "listing_id", "title"]


def test_checks(spark):
    frame = spark.createDataFrame([(1, 2)], "Title int, id int")
    assert checks.first_present(frame, ["title", "Title"]) == "Title"
    assert checks.first_present(frame, ["url"]) is None
    assert checks.column_ignoring_case(frame, "TITLE") == "Title"
    assert checks.require(frame, "id") is frame
    for bad in (lambda: checks.require(frame, "id", "url"),
                lambda: checks.first_present(frame, ["url"], needed=True),
                lambda: checks.column_ignoring_case(frame, "url")):
        with pytest.raises(ValueError):
            bad()


def test_scratch_uses_the_named_folder(spark):
    named = spark.conf.get(scratch.SETTING, None)
    if named:
        assert scratch.root(spark) == named.rstrip("/")
    assert scratch.fresh(spark, "x") != scratch.fresh(spark, "x")
    settled = scratch.settle(spark.range(3).withColumn("n", F.lit(None)))
    assert settled.count() == 3


class _Session:
    """Just enough of a session to ask where its scratch folder is."""

    def __init__(self, master, named=None):
        self.sparkContext = self
        self.master, self.named, self.applicationId = master, named, f"app-{id(self)}"
        self.conf = self

    def get(self, key, default=None):
        return self.named or default

    def getConf(self):
        return self


def test_scratch_folder_rules():
    assert scratch.root(_Session("spark://h:1", "s3a://b/x/")) == "s3a://b/x"
    with pytest.raises(RuntimeError):
        scratch.root(_Session("spark://h:1"))
    local = _Session("local[2]")
    assert scratch.root(local) == scratch.root(local)


REVIEWS = """<ul>
<li data-region="review"><p class="shop2-review-attribution"><a>Ann</a> wrote</p>
 <input name="rating" value="5"><div data-region="listing">
 <a href="/listing/1/mug?x=1" aria-label="Mug">i</a></div></li>
<li data-region="review"><p class="shop2-review-attribution">A buyer on Jun 9, 2026</p>
 <span class="stars-svg"><span class="screen-reader-only"> 4 out of 5 stars</span></span>
 <div data-region="listing"><a href="https://h/listing/2/cup#r">Cup <b>big</b></a></div></li>
<li data-region="review"><p>nothing</p></li></ul>"""


def test_review_blocks(spark):
    pages = spark.createDataFrame([(1, REVIEWS), (2, "<p>none"), (3, None)], "page_id int, html string")
    found = page_blocks.reviews(pages)
    got = found.select("page_id", "name", dates.day_text(F.col("date_text")).alias("day"),
                       text.leading_digit(F.col("rating_text")).alias("stars"),
                       urls.clean(F.col("item_href"), "https://h").alias("url"), "item_name")
    assert rows(got, *got.columns) == [
        (1, "A buyer", "09-06-2026", "4", "https://h/listing/2/cup", "Cupbig"),
        (1, "Ann", None, "5", "https://h/listing/1/mug", "Mug")]


@pytest.mark.parametrize("html, want", [
    ('<ul role="list"><li x-data="{ copied: 1 }"><div class="ml-3.5 x">Mug</div></li>'
     '<li x-data="{ copied: 1 }"><span><div>no</div><div>Cup</div></span></li></ul>', ["Mug", "Cup"]),
    ('<li x-data="copied">Tea</li><li x-data="copied">' + "x" * 51 + "</li>", ["Tea"]), ("", [])])
def test_tag_texts(spark, html, want):
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert page_blocks.tag_lists(pages).first()["items"] == want


def test_job_detail_rules(spark):
    html = """<div class="job-detail__info--title">T</div>
    <div class="job-detail__info--section"><b class="job-detail__info--section-content-title">
      mức lương</b> 10 </div>
    <div class="job-detail__info--deadline">Soon</div>
    <div class="job-detail__information-detail--actions-label">Hạn nộp: later</div>
    <div class="job-description"><div class="job-description__item"><h3>Thời gian làm việc</h3>
      <div class="job-description__item--content"><ul><li>Mon</li><li> </li><li>Tue</li></ul></div>
    </div></div><a href="/cong-ty/x">c</a>"""
    pages = spark.createDataFrame([("u", html), ("v", None)], "url string, html string")
    found = {r["url"]: r for r in page_blocks.job_details(pages, "https://j").collect()}
    row = found["u"]
    assert set(found["v"].asDict().values()) == {"v", None}
    assert (row["detail_title"], row["detail_salary"], row["deadline"], row["working_times"],
            row["company_url_from_job"], row["tags"], row["desc_mota"]) == (
        "T", "mức lương 10", "Hạn nộp: later", "Mon; Tue", "https://j/cong-ty/x", None, None)


def test_parts_of_a_job_page_stay_in_its_row(spark):
    """No rows are made of the parts that would have to be shuffled, sorted and gathered again."""
    pages = spark.createDataFrame([("u", "<h1>D</h1>")], "url string, html string")
    plan = page_blocks.job_details(pages, "https://j")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Generate" not in plan


@pytest.mark.parametrize("html, sound", [
    ('<DIV Class="y Item"><b>1</b></DIV> 5 < 6 <p class=item>2<p class=\'item\'>3', True),
    ('<p title="a > b" class="item">1</p><h1>T</h1><h1>U</h1><', True), ("", True), ("no tag", True),
    ('<p title="<p class=\'item\'>" class="item">1</p><h1>T</h1>', False),
    ('<p class="item">1</p><p class="item" x="open><h1>T</h1>', False), ('<p <b class="item">1</b><h1>T', False)])
def test_cutting_up_once_finds_what_each_search_finds(spark, html, sound):
    item, head = markup.opening(cls="item"), markup.either(markup.opening("h1"), markup.opening(cls="none"))
    page = spark.createDataFrame([(1, html)], "n int, html string")
    got = markup.cut_up(page, ["n"], {"head": head, "one": item}, {"items": item}).first()
    want = page.select(markup.first_element(F.col("html"), head), markup.first_element(F.col("html"), item),
                       markup.elements(F.col("html"), item)).first()
    assert got["_sound"] is sound
    assert (got["head"], got["one"], got["items"]) == tuple(want)


def test_company_pages(spark):
    html = """<meta property="og:title" content="Acme | Some Site VN"><div class="company-info-container">
    <div class="row"><strong>Website</strong>: acme.example</div><div class="row">Size: 10</div>
    <div class="row">Size： 20-30</div><div class="row">Phone: 1</div></div>
    <div class="description"> We <b>make</b> it </div><div class="row">Address: outside</div>"""
    pages = spark.createDataFrame([("u", html), ("v", "<title>Other</title>")], "url string, html string")
    got = jobs.companies(pages, "Some Site")
    assert rows(got, "url", "company_name_full", "company_website", "company_size",
                "company_address", "company_description") == [
        ("u", "Acme", "acme.example", "20-30", None, "We make it"),
        ("v", "Other", None, None, None, None)]


def test_jobs_first_path_wins(spark):
    cards = spark.createDataFrame([(1, "https://j/a?x=1"), (2, "https://j/a?x=2"), (3, "https://j/b")],
                                  "n int, job_url string")
    assert rows(jobs.distinct_jobs(cards, ["n"]), "n") == [(1,), (3,)]


def test_settled_rows_are_stable(spark):
    frame = scratch.settle(spark.range(100).withColumn("r", F.rand()))
    first = rows(frame, "id", "r")
    time.sleep(0.01)
    assert rows(frame, "id", "r") == first


def test_pages_are_cut_up_once_for_a_row_of_jobs(spark, monkeypatch):
    """A lookup reads its left side twice; counting keys must not cut the pages up again."""
    read = []
    visible = markup.visible
    monkeypatch.setattr(markup, "visible", lambda html: read.append(html) or visible(html))
    search = spark.createDataFrame([(1, '<div class="job-item-search-result"><h3 class="title"><a href="/a?x=1">A</a>'
                                     '</h3><a class="company" href="/c">C</a></div>')], "page_id int, html string")
    detail = spark.createDataFrame([("https://j/a?x=1", "<h1>D</h1>")], "url string, html string")
    firm = spark.createDataFrame([("https://j/c", '<h1 class="company-name">Firm | Site</h1><div class="row">'
                                   "Size: 10</div>")], "url string, html string")
    frame = runs.jobs_from_pages(search, detail, firm, "https://j", "Site")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert len(read) == 3
    # Cards and details stand in the scratch folder by now.
    assert "job-item-search-result" not in plan and "job-detail__info" not in plan
    assert rows(frame, "title", "detail_title", "company_name_full", "company_size") == [("A", "D", "Firm", "10")]


@pytest.mark.parametrize("tag, want", [
    ('<a x="1" href="">', ""), ("<a href = ' b'>", " b"), ("<a href= c>", "c"), ("<a href=c&amp;d>", "c&d"),
    ('<a href="\'q\'">', "'q'"), ('<a href="open>', None), ("<a hrefs=c>", None)])
def test_attribute_is_read_in_one_step(spark, tag, want):
    page = spark.createDataFrame([(tag,)], "html string")
    assert markup.read(page, [], {"value": ("html", markup.attribute("href"))}).first()["value"] == want


def test_grid_pages_are_cut_up_once_for_both_zones(spark):
    frame = registry.functions()["grid_zones_merged"](spark, "/root/testdata/sf0.001")
    assert "MuiDataGrid" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_raw_lines_are_written_by_as_many_tasks_as_the_session_has(spark, tmp_path, monkeypatch):
    from pathlib import Path
    from shelfmark.queries import folders
    monkeypatch.setattr(folders.scratch, "fresh", lambda session, label: f"{tmp_path}/{label}")
    changed = {"spark.sql.shuffle.partitions": "9", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        monkeypatch.setattr(folders.files, "merge_url_lines", lambda lines: lines)
        folders.raw_line_parser(spark, "/root/testdata/sf0.001")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(list(Path(tmp_path, "lines", "a").glob("part-*"))) > 4
