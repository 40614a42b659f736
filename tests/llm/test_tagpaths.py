"""Main text by tag-path ratios: the ratio stage against plain loops, alone without the name lists, and on deep, long and odd pages."""

import html
import math
import re
import time

import pytest

from isohyet.llm import common, tagpaths

SAID = "This is a sentence of the article, and it goes on for a while; then it ends. " * 4
TIDY = " ".join(SAID.split())


def gold(page):
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?p>|</?h1>", inner)]
    return "\n".join(x for x in blocks if x)


@pytest.fixture(scope="module")
def pages(spark):
    return [r.html for r in common.table(spark, "/root/testdata/sf0.01", "pages").select("html").collect()]


def naive_scores(found):
    """The fused ratio of each path, by loops over tuples of tags."""

    def chain(p):
        return (*chain(found.parent[p]), p) if p else ()

    def apart(a, b):
        a, b = chain(a), chain(b)
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        return len(a) + len(b) - 2 * k

    size = lambda t: len(" ".join(html.unescape(t).split()))
    long = [max(0, size(t) - size(a)) for t, a in zip(found.text, found.linked, strict=True)]
    marks = [sum(c in ".,;:!?…¿¡。、，" for c in html.unescape(t)) for t in found.text]
    at = {p: [k for k, q in enumerate(found.path) if q == p] for p in set(found.path)}
    mean = {p: sum(long[k] for k in ks) / len(ks) for p, ks in at.items()}
    mark = {p: sum(marks[k] for k in ks) / len(ks) for p, ks in at.items()}
    spread = {p: math.sqrt(max(0, sum(long[k] ** 2 for k in ks) / len(ks) - mean[p] ** 2)) for p, ks in at.items()}
    share = {p: sum(long[k] for k in ks) / max(1, sum(long)) for p, ks in at.items()}

    def smooth(values, k):
        total = weight = 0.0
        for j in range(max(0, k - tagpaths.RADIUS), min(len(found.path), k + tagpaths.RADIUS + 1)):
            far = apart(found.path[k], found.path[j])
            if far <= tagpaths.EDITS:
                w = math.exp(-0.5 * (((k - j) / tagpaths.RADIUS) ** 2 + far**2))
                total, weight = total + w * values[found.path[j]], weight + w
        return total / weight

    fused = [
        math.sqrt(smooth(mean, k) * (1 + smooth(mark, k))) * math.sqrt(1 + smooth(spread, k) / (1 + max(mean.values()))) * math.sqrt(share[found.path[k]])
        for k in range(len(found.path))
    ]
    return {p: sum(fused[k] for k in ks) / len(ks) for p, ks in at.items()}, tagpaths.LEVEL * sum(f * n for f, n in zip(fused, long, strict=True)) / max(1, sum(long))


def test_ratio_stage_equals_brute_force(pages):
    nested = f"<div><section><p>{SAID}</p><ul><li>a<li>b, c</ul></section><div class=x>Ad, here</div></div><p>{SAID}{SAID}"
    for page in [*pages[:40], nested]:
        for lists in (True, False):
            found = tagpaths.blocks(page, lists)
            paths, score, level, _ = tagpaths.path_scores(found)
            want, want_level = naive_scores(found)
            assert dict(zip(paths.tolist(), score.tolist(), strict=True)) == pytest.approx(want)
            assert level == pytest.approx(want_level)


def test_pages_with_lists_and_by_ratios_alone(pages):
    assert all(tagpaths.main_text(p) == gold(p) for p in pages)
    alone = sum(tagpaths.main_text(p, lists=False) == gold(p) for p in pages) / len(pages)
    assert alone >= 0.9


def test_ratios_drop_what_no_name_marks():
    page = (
        f"<body><div class='top'><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></div><div class='story'><h1>Title</h1><div class=i>Intro here</div><p>{SAID}</p><h2>Sub</h2>"
        f"<ul><li>one<li><a href=3>two</a></ul><p>Short.</p><p>{SAID}</p></div><div class='more'><ul><li><a href=4>More like this</a></ul></div><div class='base'>Imprint</div></body>"
    )
    for lists in (True, False):
        assert tagpaths.main_text(page, lists) == f"Title\nIntro here\n{TIDY}\nSub\none\ntwo\nShort.\n{TIDY}"


def test_attributes_are_parsed():
    for around in ('style="overflow:hidden"', 'data-id="nav"', 'title="a sidebar, hidden"', "data-class=comments", "class=commentary", "class='Navigator'", "onclick=\"x('nav')\""):
        assert tagpaths.main_text(f"<body><div {around}><p>{SAID}</p></div></body>") == TIDY
    for around in ("hidden", 'aria-hidden="true"', "class=sidebar", "id='comments'", "role=navigation", 'CLASS="top-nav"', "class=siteFooter", "id=sitefooter", "class='cookieBar x'"):
        assert tagpaths.main_text(f"<body><p>{SAID}</p><div {around}><p>{SAID}Gone.</p></div></body>") == TIDY


def test_unclosed_elements():
    assert tagpaths.main_text(f"<body><p>{SAID}</p><svg><g>mark<p>{SAID}</p></body>") == f"{TIDY}\n{TIDY}"
    assert tagpaths.main_text(f"<title>Name<body><p>{SAID}</p>") == TIDY
    assert tagpaths.main_text(f"<p>{SAID}</p><script>var a = '<p>{SAID}</p>'") == TIDY


@pytest.mark.parametrize("page", ["<div>" * 50_000 + f"<p>{SAID}</p>", "<div>x, y. z" * 50_000, "<b>" * 50_000 + "<li>a" * 50_000 + "<svg>" * 20_000 + "<title>" * 20_000, f"<p>{SAID}</p>" * 30_000])
def test_deep_and_long_pages_take_seconds(page):
    began = time.process_time()
    tagpaths.main_text(page)
    assert time.process_time() - began < 20


def test_slices_bound_rows_and_bytes():
    import pyarrow as pa

    texts = ["x" * n for n in (1, 5, 20, 1, 1, 1, 0, 30, 1, 1)] + [None]
    batch = pa.RecordBatch.from_pydict({"n": list(range(11)), "text": texts})
    got = list(common.slices([batch], rows=4, size=10))
    assert [x for part in got for x in part.column("text").to_pylist()] == texts
    assert all(part.num_rows == 1 or part.num_rows <= 4 and sum(len(x or "") for x in part.column("text").to_pylist()) <= 10 for part in got)


@pytest.mark.parametrize(
    "around",
    [
        '<form id="aspnetForm">', '<div id="ad-free-story">', '<div class="share-price">', '<div class="post share-buttons-on">', '<div class="menu-item">',
        '<form><div class="menu-item"><div class=share>', '<div class="comments">',
    ],
)
def test_named_wrappers_of_the_article_are_opened(around):
    ends = "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", around)))
    rest = "<nav><a href=1>Home</a></nav><div class=sidebar><p>Side text of a line or two, with a full stop.</p></div>"
    assert tagpaths.main_text(f"<body>{rest}{around}<article><h1>Title</h1><p>{SAID}</p></article>{ends}<footer>Imprint.</footer></body>") == f"Title\n{TIDY}"
    if "comments" not in around:
        assert tagpaths.main_text(f"<body>{rest}{around}<p>{SAID}</p><p>{SAID}</p>{ends}<footer>Imprint.</footer></body>") == f"{TIDY}\n{TIDY}"


def test_comments_and_notices_stay_out_however_long():
    said = "A reader says that this goes on and on, without an end. " * 40
    for comments in (f"<div class=comments><article><p>{said}</p></article></div>", f"<ol class=comment-list><li><p>{said}</p></li></ol>", f"<section id=disqus><h1>Said</h1><p>{said}</p></section>"):
        for page in (f"{comments}<article><p>{SAID}</p></article>", f"<article><p>{SAID}</p></article>{comments}", f"<form><article><p>{SAID}</p></article>{comments}</form>", f"<div class=story><p>{SAID}</p></div>{comments}"):
            assert tagpaths.main_text(f"<body>{page}</body>") == TIDY
    assert tagpaths.main_text("<body><div class=cookie-banner><p>We use cookies here, as all sites do. Go on to accept them.</p></div><nav>Menu</nav></body>") == ""
    assert tagpaths.main_text(f"<body><div class=newsletter><p>{SAID}</p></div><article><p>{SAID}Main.</p></article></body>") == f"{TIDY} Main."


def test_lists_and_ratios_do_better_than_either():
    pages = [
        (f"<form id=f><div class=top><a href=1>Home</a></div><div class=story><p>{SAID}</p></div><div class=comments><p>{SAID}</p></div></form>", TIDY),
        (f"<div class=share-price><div class=links><a href=1>One link</a> <a href=2>Two</a></div><div class=x><p>{SAID}</p><p>{SAID}</p></div></div>", f"{TIDY}\n{TIDY}"),
    ]
    every = lambda page: "\n".join(" ".join(t.split()) for t in tagpaths.blocks(page).text)
    for page, want in pages:
        assert tagpaths.main_text(page) == want
        assert every(page) != want
    assert tagpaths.main_text(pages[0][0], lists=False) != TIDY


def test_divisions_beside_the_body_come_along():
    line = "The story opens with a paragraph of its own, which tells the reader what is to come, and why."
    page = f'<body><div class="post"><div class="intro">{line}</div><div class="body"><p>{SAID}</p><p>{SAID}</p></div><div class="outro">{line}</div></div><div class="base">Imprint</div></body>'
    assert tagpaths.main_text(page) == f"{line}\n{TIDY}\n{TIDY}\n{line}"


@pytest.mark.parametrize("part", ['<b x="', "<b x='", '<b x="y', "<!", "<a", "<a ", "</title ", "<title>", '<div class="a" id=\'', "<form>", "<div class=share>a. b"])
def test_unclosed_marks_take_seconds(part):
    for page in (f"<p>{SAID}</p>" + part * (2_000_000 // len(part)), f"<p>{SAID}</p>" + part * (300_000 // len(part)) + "<p>x</p>"):
        began = time.process_time()
        tagpaths.main_text(page)
        assert time.process_time() - began < 20


def test_quotes_that_never_close():
    assert tagpaths.main_text(f'<p>{SAID}</p><p title="x>{SAID}</p><p>{SAID}</p>') == f"{TIDY}\n{TIDY}\n{TIDY}"
    assert tagpaths.main_text(f"<p title='a > b'>{SAID}</p>") == TIDY
    assert tagpaths.main_text(f"<p>{SAID}</p><p>{SAID} 1 < 2") == f"{TIDY}\n{TIDY} 1 < 2"
