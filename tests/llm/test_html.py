"""Wrapper inference and extraction."""

import html
import json
import re

from quarry.llm import html_wrapper as H

PAGES = "page_id long, url string, html string, text string"


def page(title, paragraphs, extra="", menu=("Home", "News")):
    items = "".join(f"<li><a href='/{m}'>{m}</a></li>" for m in menu)
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var x='</p><p>no';</script></head>"
            f"<body><nav><ul>{items}</ul></nav><article><h1>{title}</h1>{body}{extra}</article>"
            f"<footer>&copy; site</footer></body></html>")


def test_expression_has_slots_repeats_and_options():
    pages = [page("One", ["a", "b"]), page("Two", ["c"], menu=("Home", "About", "Contact")),
             page("Three", ["d", "e", "f"], extra="<blockquote>quoted</blockquote>")]
    w = H.infer([H.read(p) for p in pages])
    text = H.expression(w)
    assert "article(h1(#) p(#)+ blockquote(\"quoted\")?)" in text
    assert "li(#)+" in text and 'footer("© site")' in text
    assert H.content_path(w) == ("html", "body", "article")


def test_site_without_article_uses_the_slots():
    def plain(i):
        story = " ".join(f"word{i}{k}" for k in range(60))
        return (f"<html><body><div class=top><a href=/>Home</a> <a href=/x>About</a></div><div id=main><h2>Story {i}</h2>"
                f"<div class=body><p>{story}<p>More {story}</div></div><div class=sidebar>Links {i}</div></body></html>")

    w = H.infer([H.read(plain(i)) for i in range(5)])
    got = H.main_text(plain(9), H.content_path(w), set())
    assert "word90" in got and "Home" not in got and "Links" not in got


def test_constant_text_inside_the_article_is_template():
    pages = [page(f"T{i}", [f"text {i}", f"more {i}"], extra="<div class=foot2>Read our rules before posting</div>")
             for i in range(5)]
    read = [H.read(p) for p in pages]
    w = H.infer(read)
    path = H.content_path(w)
    assert H.main_text(pages[0], path, set(H.template_texts(w, path, read))) == "T0\ntext 0\nmore 0"
    copies = [H.read(pages[0].replace("Home", f"Home{i}")) for i in range(5)]
    w = H.infer(copies)
    assert H.template_texts(w, H.content_path(w), copies) == []


def test_read_of_broken_and_odd_markup():
    cases = {
        "": "", "   ": "", "plain &amp; simple\n text": "plain & simple text",
        "<p>a<p>b <b>c<br>d</b>&nbsp;e": "a\nb c d e",
        "<article><!-- <p>no</p> --><p>x&lt;y &#233;&eacute;</p><script>bad()</script><p>z": "x<y éé\nz",
        "<article><p>in</p><div class='comments'><p>reader</p></div><form>no</form><aside>no</aside></article><p>out": "in",
        "<main><ul><li>1<li>2</ul><table><tr><td>a<td>b</table></main>": "1\n2\na\nb",
        "<article><header><h1>Head</h1><span>by me</span></header><p>t</p></article>": "Head\nt",
        "<article><p>unclosed <i>tag": "unclosed tag",
        "<script>never closed": "",
    }
    for source, want in cases.items():
        assert H.main_text(source, None, set()) == want, source


def test_extract_against_the_tables_markup(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in H.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        want = "\n".join(p for p in parts if p)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_extract_edges(spark, monkeypatch):
    rows = [(1, "http://A.example/x", page("T", ["p"]), "clash"), (1, "http://a.example/x", page("T", ["p"]), "clash"),
            (2, None, page("U", ["q"]), None), (3, "http://b.example", None, None), (4, "no host", "", None),
            (5, "http://c.example:80/?q", "<p>" + "long " * 50_000, None)]
    df = spark.createDataFrame(rows, PAGES)
    want = [(1, "T\np"), (1, "T\np"), (2, "U\nq"), (3, ""), (4, ""), (5, ("long " * 50_000).strip())]
    assert sorted((r.page_id, r.text) for r in H.extract(df).collect()) == want
    monkeypatch.setattr(H, "BROADCAST_BYTES", -1)
    assert sorted((r.page_id, r.text) for r in H.extract(df).collect()) == want
    assert H.extract(df.limit(0)).count() == 0
    assert {r.host for r in H.wrappers(df).collect()} == {"a.example", "", "c.example"}


NOTICES = ["Read our rules before posting", "All prices without tax", "Sign the guest book"]


def notice_page(i, story=None):
    return page(f"Title {i}", [story or f"story {i} of its own", *NOTICES])


def test_template_texts_of_most_of_a_page_are_removed(spark):
    rows = [(i, "http://a.example/x", notice_page(i), None) for i in range(12)]
    # near copies: one story with a changed date line
    rows += [(100 + i, "http://copies.example/x", page("One", ["a long story", "its second part", f"day {i}"]), None)
             for i in range(12)]
    # different pages, and near copies of one of them
    rows += [(200 + i, "http://b.example/x", notice_page(i), None) for i in range(30)]
    rows += [(300 + i, "http://b.example/x", notice_page(0).replace("Home", f"Home{i}"), None) for i in range(12)]
    # a second layout, that the sample's content group does not hold
    rows += [(400 + i, "http://a.example/y", "<html><body><section>" + "".join(
        f"<p>{t}</p>" for t in (f"other story {i} with many words", f"more of it {i}", "Our address")) + "</section></body></html>", None)
        for i in range(6)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, PAGES)).collect()}
    for i in range(12):
        assert got[i] == f"Title {i}\nstory {i} of its own"
        assert got[100 + i] == f"One\na long story\nits second part\nday {i}"
        assert got[300 + i] == got[200] == "Title 0\nstory 0 of its own"
    for i in range(30):
        assert got[200 + i] == f"Title {i}\nstory {i} of its own"
    for i in range(6):
        assert got[400 + i] == f"other story {i} with many words\nmore of it {i}"


def test_counted_templates_equal_those_in_memory(spark):
    pages = [notice_page(i) for i in range(9)] + [page("Odd", ["no notices here"])] + [notice_page(20)] * 3
    df = spark.createDataFrame([(i, "http://a.example", p, None) for i, p in enumerate(pages)], PAGES)
    read = [H.read(p) for p in dict.fromkeys(pages)]
    w = H.infer(read)
    path = H.content_path(w)
    want = H.template_texts(w, path, read)
    assert [t for _, t in want] == NOTICES
    counted = H.templates(df, H.wrappers(df).select("host", "path")).collect()
    assert {r.host: {k: set(v) for k, v in json.loads(r.layouts).items()} for r in counted} == \
        {"a.example": {"/".join(path): {H.mark(b) for b in want}}}


def test_deep_nesting_and_unfinished_markup():
    for n in (200, 5000):
        deep = "<article>" + "<div>" * n + "<p>in</p>after" + "</div>t" * n + "</article>"
        assert H.main_text(deep, None, set()) == "\n".join(["in", "after", *["t"] * n])
        hidden = "<article>" + "<section>" * n + "<nav>menu</nav>text" + "</section>" * n + "</article>"
        assert H.main_text(hidden, None, set()) == "text"
    assert H.expression(H.infer([H.read("<div>" * 3000 + "x"), H.read("<div>" * 2000 + "y")]))
    assert H.main_text("<p>a</p><a " * 3 + "<a " * 400_000, None, set()).startswith("a\na\na")
    assert H.main_text("<p>one</p><a title='never closed><p>two</p>", None, set()) == "one\ntwo"
    assert H.main_text("<p>1 < 2 &amp; <b title='a>b'>x</b></p>", None, set()) == "1 < 2 & x"
    long = lambda n: "<main>" + "".join(f"<h2>h{i}</h2><p>p{i}</p>" for i in range(n)) + "</main>"
    assert H.content_path(H.infer([H.read(long(4000)), H.read(long(3000)), H.read(long(5))])) == ("main",)


def brute_pairs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_pairs(monkeypatch):
    import random

    rng = random.Random(3)
    cases = [([rng.choice("abc") for _ in range(rng.randrange(12))], [rng.choice("abc") for _ in range(rng.randrange(12))])
             for _ in range(300)]
    for limit in (1 << 16, 0):
        monkeypatch.setattr(H, "TABLE", limit)
        for a, b in cases:
            pairs = H._pairs(a, b)
            assert all(a[i] == b[j] for i, j in pairs)
            assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
            if limit:
                assert len(pairs) == brute_pairs(a, b)


def bare_site(kind, i):
    """Pages of two layouts without an article or telling names; what varies outside the story is short."""
    story = [" ".join(f"w{kind}{i}{k}{j}" for j in range(30)) for k in range(2 + i % 3)]
    body = "".join(f"<p>{s}</p>" for s in story)
    menu = "<div><a href=/>Start</a> <a href=/x>Contact us</a></div>"
    fixed = "<p>All pages carry this sentence below their story.</p>"
    if kind == 0:
        html_ = f"<html><body>{menu}<div class=k1><div class=k2><h2>Head {kind} {i}</h2>{body}{fixed}</div>" \
                f"<div class=k3>Seen {i} times</div></div></body></html>"
    else:
        html_ = f"<html><body><table><tr><td>{menu}</td><td><h2>Head {kind} {i}</h2>{body}{fixed}</td></tr></table></body></html>"
    return html_, "\n".join([f"Head {kind} {i}", *story])


def test_wrappers_decide_where_no_tag_or_name_does(spark, monkeypatch):
    """Fails without the wrappers: then menus and constant sentences stay."""
    rows = [(20 * kind + i, f"http://{kind}.example/{i}", *bare_site(kind, i)) for kind in (0, 1) for i in range(12)]
    pages = spark.createDataFrame(rows, PAGES)
    got = {r.page_id: r.text for r in H.extract(pages.drop("text")).collect()}
    assert got == {r[0]: r[3] for r in rows}
    alone = [H.main_text(r[2], None, set()) for r in rows]
    assert all("All pages carry" in a for a in alone)


def test_slots_win_over_an_article_that_is_not_the_story():
    def page_(i):
        story = " ".join(f"s{i}{k}" for k in range(80))
        return f"<body><article><p>Offer {i}</p></article><div><div><h1>T{i}</h1><p>{story}</p></div></div></body>"

    w = H.infer([H.read(page_(i)) for i in range(5)])
    assert H.main_text(page_(1), H.content_path(w), set()).startswith("T1\ns10")
    assert "Offer" not in H.main_text(page_(1), H.content_path(w), set())
