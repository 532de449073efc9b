"""Markup roles and the host suffix array, where they used to lose or keep too much."""

import random

import pytest

from earshot.llm import html_extract


@pytest.mark.parametrize(
    "page",
    [
        '<div style="overflow:hidden"><article><p>a b</p></article></div>',
        '<article><p>a</p> <img alt="a hidden valley"> b</article>',
        '<article>a<input type="hidden" value="x"> b</article>',
        '<article>a <img class="share-icon">b</article>',
        '<article>a <input hidden>b</article>',
        '<div class="has-sidebar no-comments"><article>a b</article></div>',
        '<div class="layout with-nav"><article>a b</article></div>',
        '<div data-class="sidebar" title="x class=footer"><article>a b</article></div>',
        "<html><head><title>T</title><body><article>a b</article></body></html>",
        "<html><head><meta charset=utf-8><article>a b</article></html>",
        '<div class="share-story-wide"><article>a b</article></div>',
        "<a href=/role/hidden><article>a b</article></a>",
    ],
)
def test_main_text_stays(page):
    assert " ".join((html_extract.main_text(page)[0] or "").split()) == "a b"


@pytest.mark.parametrize("name", ["ad", "site-footer", "cookie-notice", "main_nav", "x share-icons", "comment-list", "col-2 sidebar"])
def test_named_chrome_goes(name):
    assert html_extract.main_text(f"<article>a<div class='{name}'>x</div><div HIDDEN>y</div><div aria-hidden=true>z</div></article>")[0] == "a"


def test_landing_page_loses_what_named_pages_hold_as_chrome(spark):
    menu, foot = "start news sport culture travel money weather video archive", "all rights reserved by the example press of some town"
    rows = [(i, f"http://h.org/{i}", f"<nav>{menu}</nav><article>story number {i}</article><footer>{foot}</footer>") for i in range(3)]
    rows += [
        (7, "http://h.org/", f"<div>{menu}</div><div>welcome to us</div><div>{foot}</div><footer>{foot}</footer>"),
        (8, "http://h.org/8", f"<div>{menu}</div><p>own text</p><article class='comment'>first</article>"),
        (9, "http://h.org/9", f"<!-- <article> --><p>more text</p><div>{foot}</div>"),
        (10, "http://o.org/", f"<div>{menu}</div><nav>{foot}</nav>"),
        (11, "http://o.org/e", f"<nav>{menu} too</nav>"),
    ]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {0: "story number 0", 1: "story number 1", 2: "story number 2", 7: "welcome to us", 8: "own text", 9: "more text", 10: "", 11: ""}


def test_repeated_substrings_against_brute_force(spark):
    draw = random.Random(6)
    chunks = [[f"s{j}-{i}" for i in range(draw.randrange(5, 20))] for j in range(12)]
    rows = []
    for page in range(90):
        tokens = []
        for _ in range(draw.randrange(0, 7)):
            part = draw.choice(chunks)
            at = draw.randrange(len(part))
            tokens += part[at:] if draw.random() < 0.3 else part if draw.random() < 0.6 else [f"u{page}-{k}" for k in range(draw.randrange(9))]
        rows.append((f"h{page % 3}", page // 3 if page % 10 else 0, tokens))
    seen, want = {}, {}
    for host, page, tokens in rows:
        for i in range(len(tokens) - 7):
            seen.setdefault((host, *tokens[i : i + 8]), set()).add(page)
    for host, page, tokens in rows:
        cover = {k for i in range(len(tokens) - 7) if len(seen[(host, *tokens[i : i + 8])]) > 1 for k in range(i, i + 8)}
        if cover:
            want.setdefault((host, page), set()).update(cover)
    df = spark.createDataFrame(rows, "host string, page bigint, tokens array<string>")
    got = {(r.host, r.page): r.covered for r in html_extract.host_boilerplate(df).collect()}
    assert {k: {p for c in v for p in range(c["from"], c["to"])} for k, v in got.items()} == want
    assert all(a["to"] < b["from"] for v in got.values() for a, b in zip(v, v[1:]))


def test_named_main_text_is_protected(spark):
    menu, foot = "start news sport culture travel money weather video archive", "all rights reserved by the example press of some town"
    rows = [(i, "http://h.org/", f"<nav>{menu}</nav><article>{menu} {foot} {i}</article><footer>{foot}</footer>") for i in range(3)]
    rows.append((9, "http://h.org/", f"<p>{menu}</p><p>{foot} new</p>"))
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    text = f"{menu} {foot} 0"
    assert got[0] == (text, len(text)) and got[9] == ("new", 3)


def test_form_round_the_page_and_whole_class_tokens():
    assert html_extract.main_text("<form id=aspnetForm><nav>m</nav><article>a b</article></form>")[0] == "a b"
    assert html_extract.main_text("<article>a<div class='story-share-price'>b</div><form><p>mail</p></form></article>")[0] == "a\nb"
    assert html_extract.main_text("<label class='form-entry'>x</label><p>whole rest</p>")[0] is None
    assert html_extract.main_text("<article><p data-id='ad'>text</p></article>")[0] == "text"


LONG = "the long story of the town that was told by many people over the years and is told again here"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div>{}</div><div class='entry-meta'>by A</div>", "{}\nby A"),
        ("<div>{}</div><div class='form-entry'>x y</div>", "{}\nx y"),
        ("<div>{}</div><ul class='post-list'><li>one<li>two</ul>", "{}\none\ntwo"),
        ("<div>{}</div><article>teaser</article>", "{}\nteaser"),
        ("<header class='site'><article>{}</article></header>", "{}"),
        ("<article class='research-banner'>{}</article>", "{}"),
        ("<section class='lunch-menu'>{}</section>", "{}"),
        ("<div class='zzz-qqq'>{}</div><footer>f</footer>", "{}"),  # names that are in no list
        ("<article>{}</article><article>second one</article>", "{}\nsecond one"),
        ("<article>{}<section class='lunch-menu'>soup</section></article>", "{}"),
        ("<article></article><div class='lunch-menu'>soup</div>", ""),
        *((f"<article>{{}}<div class='{n}'>x y</div></article>", "{}") for n in ["ad-slot", "ad-container", "adsbygoogle", "related-posts", "newsletter-wrapper", "cookie-banner-wrapper", "comments-area", "commentlist", "sidebar-left"]),
    ],
)
def test_roles_are_weighed(spark, page, text):
    named, plain = html_extract.main_text(page.format(LONG))
    assert (named if named is not None else "\n".join(plain)) == text.format(LONG)


def test_the_array_decides_where_markup_does_not(spark, monkeypatch):
    frame = "home about contact all the news of our town and what else there is to read"
    rows = [(i, f"http://h.org/{i}", f"<div>{frame}</div><div class='story'>{' '.join(f'w{i}x{k}' for k in range(12))}</div>") for i in range(4)]
    # the article is shorter than what stands around it, but that is found on every page
    rows.append((9, "http://h.org/9", f"<div>{frame}</div><article>a short piece of news</article><p>{frame}</p>"))
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == {**{i: " ".join(f"w{i}x{k}" for k in range(12)) for i in range(4)}, 9: "a short piece of news"}
    none = lambda streams, run=8: streams.select("host", "page", html_extract.F.array(html_extract.F.struct(html_extract.F.lit(0).alias("from"), html_extract.F.lit(0).alias("to"))).alias("covered"))
    monkeypatch.setattr(html_extract, "host_boilerplate", none)
    without = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert all(frame in t for t in without.values())


def _texts(spark, rows):
    return {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}


def test_all_tokens_of_settled_pages_go_through_the_array(spark, monkeypatch):
    rows = [(i, f"http://h.org/{i}", f"<nav>{' '.join(f'n{k}' for k in range(10))}</nav><article><p>{' '.join(f'w{i}x{k}' for k in range(20))}</p></article>") for i in range(5)]
    held, find = [], html_extract.repeated_runs
    monkeypatch.setattr(html_extract, "repeated_runs", lambda bundles, ranges: (held.append((bundles.groupBy("main").sum("n").collect(), find(bundles, ranges).collect())), find(bundles, ranges))[1])
    assert _texts(spark, rows) == {i: " ".join(f"w{i}x{k}" for k in range(20)) for i in range(5)}
    ((sizes, repeated),) = held
    # 13 runs of each main part; the three of the menu stand on every page
    assert sum(n for main, n in sizes if main) == 65 and sum(n for main, n in sizes if not main) >= 3 and len(repeated) == 3


def test_what_is_at_home_in_one_main_part_is_no_boilerplate(spark):
    story, frame = " ".join(f"w{k}" for k in range(30)), "home about contact all the news of our town and what else there is"
    rows = [(1, "http://h.org/1", f"<nav>{frame}</nav><article>{story}</article>")]
    rows += [(i, f"http://h.org/1?print={i}", f"<div>{frame}</div><div>{story}</div><div>{i} printed</div>") for i in (2, 3)]
    assert _texts(spark, rows) == {1: story, 2: f"{story}\n2 printed", 3: f"{story}\n3 printed"}
    # named as chrome somewhere, it is
    rows.append((4, "http://h.org/4", f"<aside>{story}</aside><article>other</article>"))
    assert _texts(spark, rows) == {1: story, 2: "2 printed", 3: "3 printed", 4: "other"}


def test_weakly_named_parts_are_weighed_by_the_array(spark):
    box = " ".join(f"get our offers {k}" for k in range(12))
    page = "<article><p>short news number {}</p><div class='summer-newsletter'>{}</div></article>"
    rows = [(i, f"http://h.org/{i}", page.format(i, box)) for i in range(3)]
    rows += [(5 + i, "http://h.org/frame", f"<p>day {i}</p><div>{box}</div>") for i in range(2)]
    rows.append((9, "http://o.org/", page.format(9, box)))  # not found on other pages of its host
    got = _texts(spark, rows)
    assert {i: got[i] for i in (0, 1, 2)} == {i: f"short news number {i}" for i in range(3)} and got[9] == f"short news number 9\n{box}"


@pytest.mark.parametrize("copies", [500_000, 0])
def test_repeated_runs_of_pages_against_brute_force(spark, monkeypatch, copies):
    draw = random.Random(copies)
    chunks = [[f"s{j}-{i}" for i in range(draw.randrange(8, 16))] for j in range(14)]
    rows, pages = [], {}
    for i in range(150):
        host, parts = f"h{i % 3}.org", []
        for _ in range(draw.randrange(1, 5)):
            parts.append((draw.choice(["nav", "article", "p"] if i % 2 else ["nav", "p"]), draw.choice(chunks) if draw.random() < 0.6 else [f"u{i}-{k}" for k in range(9)]))
        if i % 7 == 0 and i > 50:  # a copy of another page, on its host or elsewhere
            parts = pages[i - draw.choice([21, 22, 24])][1]
        pages[i] = (host, parts)
        rows.append((host, "".join(f"<{t}>{' '.join(w)}</{t}>" for t, w in parts)))
    out, home, chrome = {}, {}, set()
    for host, parts in pages.values():
        tags = {t for t, _ in parts}
        decided, name = "article" in tags and "p" not in tags, str([w for _, w in parts])
        words = [(w, "main" if decided and t == "article" else t) for t, held in parts for w in held]
        for i in range(len(words) - 7):
            run, kinds = (host, *(w for w, _ in words[i : i + 8])), {k for _, k in words[i : i + 8]}
            if "main" not in kinds:
                out.setdefault(run, set()).add(name)
                if kinds == {"nav"}:
                    chrome.add(run)
            elif kinds == {"main"}:
                home.setdefault(run, set()).add(name)
    at_home = {r for r, found in out.items() if len(found) <= 3 and r not in chrome and len(home.get(r, ())) == 1}
    want = {(r, r in at_home) for r, found in out.items() if len(found) > 1 or r in at_home}
    assert at_home and any(r in home for r, kept in want if not kept)
    monkeypatch.setattr(html_extract, "BUNDLE_RUNS", 300)
    monkeypatch.setattr(html_extract, "COPIES", copies)
    df = spark.createDataFrame([(i, h, f"http://{h}/", t) for i, (h, t) in enumerate(rows)], "page_id bigint, host string, url string, html string").repartition(4)
    held, find = [], html_extract.repeated_runs
    monkeypatch.setattr(html_extract, "repeated_runs", lambda bundles, ranges: (held.append(find(bundles, ranges).collect()), find(bundles, ranges))[1])
    html_extract.extract(df).count()
    hashes = {(int(html_extract.run_hashes([r[0]], [list(r[1:])], 8)[2][0]), kept) for r, kept in want}
    assert sorted(map(tuple, held[0])) == sorted(hashes) and len(hashes) == len(want)
