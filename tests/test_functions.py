"""Column functions on single values."""

import datetime

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import artwork, dates, labels, metrics, names, text, urls
from shelfmark.sources import pages


def lit(value):
    return F.lit(value) if value is not None else F.lit(None).cast("string")


@pytest.mark.parametrize("raw, want", [
    ("  a\u00a0\t b\n", "a b"), ("\u00a0\t", None), ("", None), (None, None)])
def test_squeeze_knows_unicode_blanks(evaluate, raw, want):
    assert evaluate(text.squeeze(lit(raw))) == want


@pytest.mark.parametrize("raw, want", [
    ("1,234.5", 1234.5), (" 7 ", 7.0), ("n/a", None), ("", None), (None, None)])
def test_to_number(evaluate, raw, want):
    assert evaluate(text.to_number(lit(raw))) == want


@pytest.mark.parametrize("raw, want", [("3", 3), ("2.9", 2), ("bad", 1), (None, 1)])
def test_to_int_default(evaluate, raw, want):
    assert evaluate(text.to_int(lit(raw), 1)) == want


def test_tag_functions(evaluate):
    got = evaluate(
        text.normal_tags(F.lit("a; b ,c;;")),
        text.tags_from_array(F.array(F.lit(" a"), F.lit(""), lit(None), F.lit("b "))),
        F.array_join(text.distinct_ignoring_case(F.array(*map(F.lit, ["Mug", "mug", "Cup", "MUG"]))),
                     "|"),
        F.array_join(text.distinct_urls(F.array(*map(F.lit, ["u1.", "u1", "u2.,"]))), "|"))
    assert got == ["a, b, c", "a; b", "Mug|Cup", "u1|u2"]


@pytest.mark.parametrize("raw, label, value", [
    ("Website: http://x", "Website", "http://x"), ("Quy mô：100", "Quy mô", "100"),
    ("no colon", None, None), (": only value", None, None)])
def test_label_and_value(evaluate, raw, label, value):
    assert evaluate(text.label_of(F.lit(raw)), text.value_of(F.lit(raw))) == [label, value]


@pytest.mark.parametrize("label, kind", [
    ("Trang  web", "website"), ("Company SIZE", "size"), ("Ngành nghề", "industry"),
    ("Địa chỉ", "address"), ("Phone", None)])
def test_label_class(evaluate, label, kind):
    assert evaluate(text.label_class(F.lit(label))) == kind


@pytest.mark.parametrize("raw, name, day", [
    ("Ann on May 1, 2026", "Ann", "May 1, 2026"), ("Ann", "Ann", None),
    ("Ron on on May 1", "Ron", "on May 1")])
def test_name_on_date(evaluate, raw, name, day):
    assert evaluate(text.before_on(F.lit(raw)), text.after_on(F.lit(raw))) == [name, day]


@pytest.mark.parametrize("raw, want", [
    ("Jun 9, 2026", "09-06-2026"), ("on September 10, 2025", "10-09-2025"),
    ("ON Sep 1, 2025", "01-09-2025"), ("yesterday", "yesterday"), ("Jun 39, 2026", "Jun 39, 2026")])
def test_day_text(evaluate, raw, want):
    assert evaluate(dates.day_text(F.lit(raw))) == want


@pytest.mark.parametrize("raw, want", [
    ("Berlin on Oct 9, 2025", "2025-10-09"), ("X on October 9,2025", "2025-10-09"),
    ("X on Foo 9, 2025", "Foo 9, 2025"), ("nothing", None), (None, None)])
def test_review_day(evaluate, raw, want):
    part = dates.review_date_part(lit(raw))
    assert evaluate(dates.review_day_text(part, dates.review_day(part))) == want


def test_deadline(evaluate):
    got = evaluate(dates.deadline_text(F.lit("Hạn nộp: 3/12/2026!")),
                   dates.deadline_text(F.lit("soon")), dates.deadline_day(F.lit("31/2/2026")),
                   dates.deadline_day(F.lit("03/12/2026")))
    assert got == ["3/12/2026", "soon", None, datetime.date(2026, 12, 3)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, evaluate, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = evaluate(
            dates.created_at(lit(None), F.lit("65920080" + "0" * 16)),
            dates.created_at(F.lit("2026-06-05T20:59:13.180Z"), F.lit("65920080" + "0" * 16)),
            dates.day_code(dates.created_at(F.lit("2026-06-05T20:59:13.180Z"), F.lit("zz"))))
        assert got == [datetime.datetime(2024, 1, 1, 7, 0),
                       datetime.datetime(2026, 6, 6, 3, 59, 13, 180000), "060626"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("raw, want", [
    ("https://a.b/c/1?x=1#y", "/c/1"), ("/c/1?x", "/c/1"), ("//h/p#q", "/p"), ("https://a.b", "")])
def test_url_path(evaluate, raw, want):
    assert evaluate(urls.path(F.lit(raw))) == want


def test_urls(evaluate):
    got = evaluate(
        urls.clean(F.lit("/listing/5/x?ref=1#t"), "https://h"), urls.clean(F.lit("http://z/a#b"), "h"),
        urls.listing_id(F.lit("https://h/listing/55/a")), urls.listing_id(F.lit("https://h/shop/55")),
        urls.extension(F.lit("https://h/a/b.PNG?x=.gif")), urls.extension(F.lit("https://h.x/a")),
        urls.mime(F.lit("a.JPEG")), urls.mime(F.lit("a.tiff")), urls.is_local(F.lit("C:/a.png")),
        urls.is_local(F.lit("https://a")), urls.stem(F.lit("d/a.b.png")), urls.stem(F.lit(".env")),
        urls.number_in(F.lit("d9/image_12.jpg")), urls.number_in(F.lit("d9/cover.jpg")))
    assert got == ["https://h/listing/5/x", "http://z/a", "55", None, ".PNG", ".jpg", "image/jpeg",
                   "application/octet-stream", True, False, "a.b", ".env", 12, 0]


@pytest.mark.parametrize("counter, want", [(1, "01"), (99, "99"), (100, "100"), (1234, "1234")])
def test_sku_counter_is_never_cut(evaluate, counter, want):
    assert evaluate(names.make_sku(F.lit(counter), F.lit("050626"))) == f"NTD050626A{want}"


@pytest.mark.parametrize("name, sku, title", [
    ("[NTD050626A32] Mug [big]", "NTD050626A32", "Mug [big]"), (" NTD050626A32 ", "NTD050626A32", None),
    ("Mug", None, None), ("[x] Mug", None, "Mug")])
def test_name_parts(evaluate, name, sku, title):
    assert evaluate(names.sku_of(F.lit(name)), names.title_of(F.lit(name))) == [sku, title]


def test_descriptions(evaluate):
    desc = "x\n**Title:** Mug \n\n**Tags:** a; b,\nc\n\n**Etsy URL:** u"
    got = evaluate(
        names.described_title(F.lit(desc)), names.leading_title(F.lit(desc)),
        names.described_tags(F.lit(desc)), names.desc_ok(F.lit(desc)), names.desc_ok(lit(None)),
        names.name_ok(F.lit("[NTD050626A32] M")), names.name_ok(F.lit("[NTD050626A32]M")),
        names.description(F.lit("T"), F.lit(""), F.lit("u")))
    assert got == ["Mug", None, "a, b, c", False, True, True, False,
                   "**Title:** T\n\n**Etsy URL:** u"]


def test_card_key(evaluate):
    got = evaluate(names.card_key(F.lit("7"), F.lit("t" * 90)), names.card_key(lit(None), F.lit("t" * 90)))
    assert got == ["7 — " + "t" * 60, "t" * 80]


def test_metrics(evaluate):
    views, age = F.lit(100.0), F.lit(3.0)
    got = evaluate(metrics.views_per_month(views, age), metrics.views_per_month(views, F.lit(0.0)),
                   metrics.engagement_rate(F.lit(1.0), F.lit(3.0)),
                   metrics.engagement_rate(F.lit(1.0), F.lit(0.0)),
                   metrics.competition_score(F.lit(50.0), metrics.views_per_month(views, age)))
    assert got == [33.3, None, 0.3333, None, 1.5]


@pytest.mark.parametrize("stem, tone", [
    ("white-shirt", "light"), ("shirt_NAVY", "dark"), ("white_navy", "light"), ("whitewash", "mid")])
def test_tone(evaluate, stem, tone):
    assert evaluate(artwork.tone(F.lit(stem))) == tone


@pytest.mark.parametrize("w, h, want", [
    (77, 100, "square"), (76, 100, "portrait"), (130, 100, "square"), (131, 100, "landscape"),
    (1, 0, None)])
def test_shape(evaluate, w, h, want):
    assert evaluate(artwork.shape(F.lit(w), F.lit(h))) == want


@pytest.mark.parametrize("index, url, column", [
    (2, "b", "image_2"), (0, "a", "image_1"), (-3, "a", "image_1"), (3, "a", "image_1"),
    (9, "a", "image_1")])
def test_image_at(evaluate, index, url, column):
    images = F.array(F.lit("a"), F.lit("b"), F.lit(""))
    assert evaluate(artwork.image_at(images, F.lit(index)),
                    artwork.image_column_at(images, F.lit(index))) == [url, column]


@pytest.mark.parametrize("stem, want", [
    ("pose_AB_1", "pose_AB"), ("B7", "pose_B"), ("ab-1", "pose_AB"), ("cab", "pose_A"), ("x", "pose_A")])
def test_config_key(evaluate, stem, want):
    assert evaluate(artwork.config_key(F.lit(stem), ["pose_A", "pose_B", "pose_AB"])) == want


def test_config_key_without_fallback(evaluate):
    assert evaluate(artwork.config_key(F.lit("zzz"), ["sides_A"], fallback=False)) is None


@pytest.mark.parametrize("stem, want", [
    ("Cat_Front", "cat"), ("cat-back", "cat"), ("_cat_f_x", "catx"), ("cat_front_back", "cat")])
def test_pair_key(evaluate, stem, want):
    assert evaluate(artwork.pair_key(F.lit(stem))) == want


def test_labels(evaluate):
    niches = {"lamp": ["Lamp", "light"], "none": [], "diver": ["scuba"]}
    subs = {"anime lamp": {"parent": "lamp", "keywords": ["anime"]}, "any": {"keywords": ["anime"]}}
    got = evaluate(
        labels.niche(F.lit("scuba LIGHT"), niches), labels.niche(F.lit("cup"), niches),
        labels.niche(F.lit("x"), {}), labels.sub_niche(F.lit("Anime"), F.lit("lamp"), subs),
        labels.sub_niche(F.lit("Anime"), lit(None), subs))
    assert got == ["lamp", None, None, "anime lamp", "any"]


def test_page_functions(evaluate):
    html = ('<title>T</title><script>x="<h1>no</h1>"</script><h1>A &amp;\n <b>B</b> | Site x</h1>'
            '<a href="https://i.h/full/1">1</a><a class="k" href="https://i.h/full/1">1</a>'
            '<a href="https://i.h/small">s</a><!-- captcha -->')
    got = evaluate(
        pages.site_name(F.lit(html.replace('<script>x="<h1>no</h1>"</script>', "")), "Site"),
        F.array_join(pages.links_with(F.lit(html), "i.h", "full"), "|"),
        pages.page_text(F.lit(html)),
        pages.next_page(F.lit("/r?page=2"), F.array(F.lit("/r?page=1"), F.lit("/r?page=3")), lit(None)),
        pages.next_page(F.lit("/r?page=2"), F.array(F.lit("/r?page=9")), F.lit("/r?page=4")))
    assert got == ["A & B", "https://i.h/full/1", "T A & B | Site x 1 1 s", "/r?page=3", "/r?page=4"]


@pytest.mark.parametrize("status, url, words, h1, want, live", [
    (404, "h/listing/1", "", True, True, True), (200, "h/listing/1", "page not found", True, True, True),
    (200, "h/listing/1", "captcha", True, None, False), (200, "h/search", "ok", True, True, True),
    (200, "h/listing/1", "ok", True, False, False), (200, "h/listing/1", "ok", False, None, False),
    (None, "h/listing/1", "ok", False, None, None)])
def test_page_states(evaluate, status, url, words, h1, want, live):
    code = F.lit(status).cast("int")
    assert evaluate(pages.is_gone(code, F.lit(url), F.lit(words), F.lit(h1)),
                    pages.is_gone_live(code, F.lit(url), F.lit(words))) == [want, live]
