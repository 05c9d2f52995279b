from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from jobmart import schemas
from jobmart.operators import pages

LIST = """<html><body><div class="nav"><label class="exp"><span>menu</span></label></div>
<div data-job-id="11" class="job-item-search-result big"><div class="avatar"><a href="/pic"></a></div>
<h3 class="big title"><a target="_blank" href="https://h/11.html?ta=1">
<span class="b" data-original-title=" Senior Java &amp; Go ">Senior..</span></a></h3>
<a class="company" href="#"><span class="company-name"> ACME <b>Co</b> </span></a>
<label class="title-salary"> 10 - 20 triệu </label><label class='address'><span class="city-text">
Hà Nội</span></label><label class="exp"><span>2 năm</span></label>
<div class="tag"><a class="item-tag">Java</a><div><a class="item-tag zz">Go</a></div></div></div>
<div class="job-item-search-result" data-job-id='12'><div class="avatar"><a href="/p/12?q"
 title="T12"></a></div><label class="salary"><span>Thoả thuận</span></label></div>
<div class="job-item-search-result-not" data-job-id="13"></div>
<label class="exp"><span>OUTSIDE</span></label></body></html>"""

DETAIL = """<div id="box-job-information-detail"><div class="job-tags__group">
<div class="job-tags__group-name">Yêu cầu:</div><div><a class="item">Nam</a>
<a class="item" href="x">Tuổi 22 - 35</a><a class="item-not">no</a></div></div>
<div class="job-tags__group"><div class="job-tags__group-name">Chuyên môn</div>
<a class="item">Backend Developer</a></div></div>
<div class="job-description__item"><h3>Mô tả công việc</h3>
<div class="job-description__item--content"><p>a</p><div>n<div>m</div></div></div><p>after</p></div>
<div class="job-description__item"><h3>Yêu cầu ứng viên</h3>
<div class="job-description__item--content">req</div></div>
<div class="job-description__item"><h3>Quyền lợi</h3></div>
<div class="job-description__item"><div class="job-description__item--content">no head</div></div>
<div class="job-detail__information-detail--actions-label">Hạn nộp hồ sơ: 31/03/2026</div>"""


def test_listing(spark):
    df = spark.createDataFrame([(1, LIST), (2, "<html></html>"), (3, None)], "page_id int, html string")
    rows = [r.asDict() for r in pages.listing(df).orderBy("position").collect()]
    assert rows == [
        {"page_id": 1, "position": 0, "job_id": "11", "title": "Senior Java & Go",
         "url": "https://h/11.html", "company": "ACMECo", "salary": "10 - 20 triệu",
         "location": "Hà Nội", "experience": "2 năm", "tags": ["Java", "Go"]},
        {"page_id": 1, "position": 1, "job_id": "12", "title": "T12", "url": "/p/12",
         "company": "", "salary": "Thoả thuận", "location": "", "experience": "", "tags": []},
    ]


def test_detail(spark):
    df = spark.createDataFrame([("u", DETAIL), ("v", "")], "url string, html string")
    full, empty = [r.asDict() for r in pages.detail(df).orderBy("url").collect()]
    assert full == {
        "url": "u", "tags_requirement": ["Nam", "Tuổi 22 - 35"],
        "tags_specialization": ["Backend Developer"],
        "mo_ta_cong_viec_html":
            '<div class="job-description__item--content"><p>a</p><div>n<div>m</div></div></div>',
        "yeu_cau_ung_vien_html": '<div class="job-description__item--content">req</div>',
        "quyen_loi_html": "", "deadline": "Hạn nộp hồ sơ: 31/03/2026"}
    assert empty == {"url": "v", "tags_requirement": [], "tags_specialization": [],
                     "mo_ta_cong_viec_html": "", "yeu_cau_ung_vien_html": "",
                     "quyen_loi_html": "", "deadline": ""}


@pytest.mark.parametrize("link, title", [
    ('<a><span data-original-title="tip">text</span></a>', "tip"),
    ('<a><span data-original-title=" "> text </span></a>', "text"),
    ('<a title=" t " aria-label="l">x</a>', "t"),
    ("<a title='' aria-label='l'>x</a>", "l"),
    ("<a> <b>x</b> y </a>", "xy"),
    ("<a></a>", ""),
])
def test_title_chain(spark, link, title):
    df = spark.createDataFrame([(link,)], "s string")
    assert df.select(pages.title_of(F.col("s"))).first()[0] == title


def test_blocks_are_cut_at_their_own_end(spark):
    texts = ['div<div class="k">a<div>b</div>c', '<div class="k">a</div>b<div></div>',
             '<DIV class="x k">1<dIv/></DIV></Div>t<div class="kk"></div><div class=\'k\'>2</div>',
             "", "<divider class='k'>no</divider>"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = [r[1] for r in df.select("i", pages.blocks(F.col("s"), cls="k")).orderBy("i").collect()]
    assert got == [['<div class="k">a<div>b</div>c'], ['<div class="k">a</div>'],
                   ['<DIV class="x k">1<dIv/></DIV></div>', "<div class='k'>2</div>"], [], []]


def test_merge_keeps_rows_without_detail(spark):
    listed = spark.createDataFrame([("1", "u"), ("2", "w")], "job_id string, url string")
    details = spark.createDataFrame([("u", "d")], "url string, deadline string")
    got = {r.job_id: r.deadline for r in pages.merge(listed, details).collect()}
    assert got == {"1": "d", "2": None}


def test_adverts_from_list_and_detail_pages(spark):
    lists = spark.createDataFrame([(LIST,), ("<html></html>",), (None,), (LIST.replace("11", "21").replace("12", "22"),)], "html string")
    details = spark.createDataFrame([("https://h/11.html?x=1", DETAIL), ("https://h/11.html", DETAIL), ("", DETAIL), (None, DETAIL)],
                                    "url string, html string")
    df = pages.adverts(lists, details)
    assert df.schema.fieldNames() == schemas.POSTING.fieldNames()
    got = {r.job_id: (r.url, r.title, r.tags_specialization, r.deadline) for r in df.collect()}
    assert got == {"11": ("https://h/11.html", "Senior Java & Go", ["Backend Developer"], "Hạn nộp hồ sơ: 31/03/2026"),
                   "12": ("/p/12", "T12", None, None), "21": ("https://h/21.html", "Senior Java & Go", None, None),
                   "22": ("/p/22", "T22", None, None)}
    assert df.count() == 4
    nothing = spark.createDataFrame([], "url string, html string")
    assert pages.adverts(lists, nothing).count() == 4 and pages.adverts(nothing, details).count() == 0


def plain_blocks(html, name):
    """Elements by a counter over all div tags."""
    import re

    out, start, depth = [], None, 0
    for tag in re.finditer(r"<(/?)div(?=[\s>/])[^>]*>", html):
        if start is None:
            if not tag[1] and f'class="{name}"' in tag[0]:
                start, depth = tag.start(), 1
            continue
        depth += -1 if tag[1] else 1
        if depth == 0:
            out.append(html[start:tag.start()] + "</div>")
            start = None
    return out + ([html[start:]] if start is not None else [])


def test_blocks_of_long_and_broken_pages(spark):
    import random
    import time

    rng = random.Random(4)
    tags = ['<div class="x">', "<div>", "</div>", "</div>", "t", "<p>"]
    htmls = ["".join(rng.choices(tags, k=n)) for n in (0, 1, 5, 64, 65, 300, 300, 900) for _ in range(4)]
    item = '<div class="x"><div>a<div>b</div></div></div>\n'
    htmls.append("<div>" + item * 10_000)
    df = spark.createDataFrame(list(enumerate(htmls)), "i int, html string")
    began = time.time()
    got = {r.i: r.b for r in df.select("i", pages.blocks(F.col("html"), cls="x").alias("b")).collect()}
    assert time.time() - began < 60
    assert got == {i: plain_blocks(h, "x") for i, h in enumerate(htmls)}
