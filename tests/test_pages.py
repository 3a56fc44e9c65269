"""Styled blocks and article metadata of planted pages."""

import pytest

from timeloom.sources import articles, html


def test_class_rules():
    css = r'''.a{font-weight:700}.b{font-style : italic;text-decoration:underline}.c{content:"\2022 "} .d{font-weight:400;content:"\"x\" &amp;"}.a1{font-weight:bold}.z{content:"\FFFFFF"}'''
    assert html.class_rules(css) == {"a": ({"bold"}, ""), "b": ({"italic", "underline"}, ""), "c": (set(), "•"), "d": (set(), '\\'), "a1": ({"bold"}, ""), "z": (set(), "")}
    assert html.css_text(r"\41 b\'c\' &lt;") == "Ab'c' <"


def test_styles_by_classes():
    page = """<style>.h{font-weight:600}.i{font-style:italic}.m{content:"- "}.k{content:"\\2713"}</style>
    <p class="h">all bold</p><p>a <span class="h i">both</span> and <b>one</b><b> two</b>, <b>x</b> <u>under <i>it</i></u> #tag #a #été2</p>
    <ul class="m"><li>dash</li></ul><ul><li class="k">done</li><li>dot<p>in it</p></li></ul><ol><li>first</li></ol><li class="li-bullet-3">loose</li><ul><li><input type="checkbox"/>box</li></ul><p>plain</p>"""
    blocks = [(b["tag"], b["text"], b["list_kind"], b["marker"], b["bold"], b["italic"], b["underline"], b["hashtags"]) for b in html.read_page(page)[0]]
    none = ([], [], [], [])
    assert blocks == [
        ("p", "all bold", None, None, ["all bold"], [], [], []), ("p", "a both and one two, x under it #tag #a #été2", None, None, ["both", "one two"], ["both", "it"], ["under it"], ["tag", "été2"]),
        ("li", "dash", "dash", "- ", *none), ("li", "done", "check", "✓", *none), ("li", "dot", "bullet", None, *none), ("p", "in it", None, None, *none),
        ("li", "first", "number", None, *none), ("li", "loose", "bullet", None, *none), ("li", "box", "check", None, *none), ("p", "plain", None, None, *none),
    ]
    assert html.read_page("<b>never closed <p>x y</p></i></div>")[0][0]["bold"] == ["x y"] and html.read_page(None) == ([], [])


LINKED = '<script type="application/ld+json">{"@graph": [{"@type": "WebSite", "name": "Site"}, {"@type": ["NewsArticle"], "headline": "From data", "author": [{"name": "By Ann Lee and Bo Ek"}, "AFP"], "datePublished": "2021-03-05T10:00:00+02:00"}]}</script>'
PAGES = [
    ("https://x.org/2020/01/02/a", f"<title>The page - BBC</title>{LINKED}<h1>The <em>page</em></h1><meta name='author' content='Ann Lee; Staff'>", ("The page", ["Ann Lee", "Bo Ek", "AFP"], "2021-03-05T08:00:00Z")),
    ("https://x.org/2020/01/02/a", "<script type='application/ld+json'>{broken</script><title> T </title>", ("T", [], "2020-01-02")),
    ("https://x.org/20200102", "<meta property='og:title' content='Meta &amp; more'><div class='the-byline'>Par <b>Zoé</b> | newsletter</div>", ("Meta & more", ["Zoé"], "2020-01-02")),
    ("https://x.org/a", "<time>5 mars 2021</time><time datetime='2020-02-03'>x</time>", (None, [], "2021-03-05")),
    ("https://x.org/2020/13/45/", "<time datetime='Tue, 05 Mar 2019 10:00:00 GMT'/><p itemprop='author'>Ann</p>", (None, ["Ann"], "2019-03-05T10:00:00Z")),
    (None, None, (None, [], None)), ("https://x.org/a-b_12", "", (None, [], None)),
]


def test_article_metadata(spark):
    pages = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(PAGES)], "page_id int, url string, html string")
    got = articles.article_metadata(pages, ["page_id"]).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in got] == [w for _, _, w in PAGES]


@pytest.mark.parametrize("text, want", [("2021-03-05", "2021-03-05"), ("2021-03-05T10:00", "2021-03-05T10:00:00"), ("on 2021/3/5 at", "2021-03-05"), ("le 5 août 2021", "2021-08-05"), ("le 5 aout 2021", "2021-08-05"), ("31 février 2021", None), ("soon", None), (None, None)])
def test_iso_dates(text, want):
    assert articles.iso_date(text) == want


def test_script_blocks_without_times(spark):
    video = "<a href='https://youtu.be/x'>v</a>"
    parts = ["a (01:00-01:15) b", "a [1:00 to 1:10]", "a (12:05) b", "a (x) b", "see 03:10-4:10 here", f"{video} 03:10-4:10 here", f"{video} 1min02-1min10 now", f"{video} 10 s à 2 min end", f"{video} -1:20", "(00:10-)", f"{video} 5 apples", "<a href='https://a.org'>v</a> 03:10-4:10"]
    want = ["a b", "a", "a b", "a (x) b", "see 03:10-4:10 here", "v here", "v now", "v end", "v", None, "v 5 apples", "v 03:10-4:10"]
    page = spark.createDataFrame([(1, "".join(f"<p>{p}</p>" for p in parts))], "page_id int, html string")
    got = {r["block_no"]: r["text"] for r in html.script_blocks(page, ["page_id"]).collect()}
    assert [got.get(i) for i in range(len(parts))] == want


def test_links_in_context(spark):
    page = "<p>before <a href='/x'>the link</a> behind, see www.a.org/b?c=1. and http://c.org/d)</p><p><a href='http://c.org'>http://c.org</a> http://c.org again</p><a href='/y'>loose</a><p>none</p>"
    df = spark.createDataFrame([(1, page), (2, None)], "page_id int, html string")
    got = {tuple(r)[1:] for r in html.links_in_context(df, ["page_id"], before=7, after=4).collect()}
    assert got == {
        (0, "anchor", "/x", "the link", "before the link beh"), (0, "text", "www.a.org/b?c=1", "www.a.org/b?c=1", "d, see www.a.org/b?c=1. an"), (0, "text", "http://c.org/d", "http://c.org/d", "1. and http://c.org/d)"),
        (1, "anchor", "http://c.org", "http://c.org", "http://c.org htt"), (2, "anchor", "/y", "loose", "loose"),
    }


def test_scripts_and_manifests(spark, tmp_path):
    import os

    from pyspark.sql import functions as F

    from timeloom.functions.text import script_paragraph, without_title
    from timeloom.operators.layout import pack_tracks
    from timeloom.sources.documents import newest_manifest

    texts = ["\n \n Titre: x\n\n a\nb", "a\nTITRE b", "\n\n", "TITRE", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(without_title(F.col("t"))).collect()] == [" a\nb", "a\nTITRE b", "", "", ""]
    lines = spark.createDataFrame([(t,) for t in ["  extrait 3", "Insert", "an insert", "a  https://x.y/z b www.c.d", None]], "t string")
    assert [r[0] for r in lines.select(script_paragraph(F.col("t"))).collect()] == ["", "", "an insert", "a b", ""]
    for i, body in enumerate(['{"entries": [{"a": 1}]}', '{"entries": [{"a": 2}, {"a": 3}]}', '{"other": 1}']):
        (tmp_path / f"{i}.json").write_text(body)
        os.utime(tmp_path / f"{i}.json", (1_700_000_000 + i * 100,) * 2)
    assert sorted(r["a"] for r in newest_manifest(spark, str(tmp_path)).collect()) == [2, 3]
    clips = spark.createDataFrame([(0, 10), (2, 8), (3, 5), (6, 9), (10, 12)], "s int, e int").withColumn("k", F.lit(1))
    got = pack_tracks(clips, ["k"], "s", "e", ["s"], "s int, track int", base=1, reserved={2}).collect()
    assert sorted(map(tuple, got)) == [(0, 1), (2, 3), (3, 4), (6, 4), (10, 1)]
