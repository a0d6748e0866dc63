"""Wrappers are inferred from all distinct pages of a host, whatever their number."""

from collections import Counter

from quarry.llm import html_wrapper as H


def test_dump_keeps_the_wrapper():
    w = H.infer([H.read("<div class=a>x<p>1</p><p>2</p></div><aside>n</aside>"), H.read("<div class=a>y<ul><li>3</ul></div>")])
    again = H.load(H.dump(w))
    assert H.expression(again) == H.expression(w) and H.dump(again) == H.dump(w)


def test_every_distinct_page_of_a_host_counts_once(spark, monkeypatch):
    # one page of a hundred has each box: a sample of pages misses some of them
    boxes = [f"<div class=box{i}>only here {i}</div>" for i in range(100)]
    pages = [(i, "http://a.example/x", f"<html><body><h1>t{i}</h1>{box}</body></html>") for i, box in enumerate(boxes)]
    pages += [(1000 + i, *p[1:]) for i, p in enumerate(pages[:20])] + [(2000, "http://b.example/", "<p>one</p>"), (2001, None, None)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(5)
    for part, merged in ((64, 16), (4, 2)):
        monkeypatch.setattr(H, "PART_PAGES", part)
        monkeypatch.setattr(H, "MERGED", merged)
        got = {r.host: r.expression for r in H.wrappers(df).collect()}
        assert set(got) == {"a.example", "b.example"}
        found = Counter(f"div.box{i}(" in got["a.example"] for i in range(100))
        assert found == {True: 100}
