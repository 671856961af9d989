"""Plain pages are read by their tokens, all others by Python's parser: with the same result."""

import random

import pytest
from pyspark.sql import functions as F

from folioflow.sources import html_pages as h

PIECES = [
    "<a href='/x?a=1'>", '<a class="next" rel="R" href="/y">', "</a>", "<A HREF='/z' >", "<h1>", "</h1>", "<h2>", "</H2>", "<meta name='DC.date' content=\" 1 \">", "<meta property='p' content=''>", "<p>", "</p >", "text &amp; more", " \t\n", "&quot", "&#x41;", "x &lt",
    "<br/>", "<!-- c -->", "<script>a<b</script>", "<style>", "</style>", "<a href=bare>", "<", ">", "<a href='&amp;'>", "<a href='1' href='2'>", "<!doctype html>", "<title>t &amp; u</title>", "</a x='1'>", "<textarea><a href='/n'></textarea>", "ü", "<a\x0bhref='/v'>", "&", "<img src='x'>",
]


def plainly(html, wants=h.PARTS):
    p = h._Page(wants)
    p.feed(html)
    p.close()
    p.close_anchor()
    return {"anchors": p.anchors, "metas": p.metas, "heading": p.heading, "text": " ".join(" ".join(p.words).split())}


def test_tokens_agree_with_the_parser():
    dice, plain = random.Random(5), 0
    for n in range(30_000):
        html = "".join(dice.choice(PIECES[: 17 if n % 2 else None]) for _ in range(dice.randrange(12)))
        assert h._read(html, h.PARTS) == plainly(html), html
        plain += h._Page().plain(html)
    assert plain > 5_000


def test_parts_that_are_asked_for(spark):
    html = "<h1>T</h1><a href='/x'>l</a><meta name='n' content='c'>"
    row = spark.createDataFrame([(html,)], "x string").select(h.parse(F.col("x"), ("anchors",)).alias("p")).first()["p"]
    assert [a["text"] for a in row["anchors"]] == ["l"] and row["metas"] == [] and row["heading"] is None and row["text"] == ""
    with pytest.raises(ValueError, match="no such part"):
        h.parse(F.col("x"), ("links",))


def test_no_batch_is_held_as_objects(spark, monkeypatch):
    assert h.CHUNK <= 64
    pages = spark.range(300).select(F.concat(F.lit("<a href='/"), F.col("id").cast("string"), F.lit("'>x</a>")).alias("x")).coalesce(1)
    got = pages.select(h.parse(F.col("x"), ("anchors",))["anchors"][0]["href"].alias("v")).collect()
    assert [r["v"] for r in got] == [f"/{k}" for k in range(300)]
