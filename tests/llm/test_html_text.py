import math
import random
import time

import pytest

from stratalode.llm.html_text import content_paths, extract, extract_text

PARAGRAPH = "A sentence of some length, with commas, and a stop. Another one follows, as is usual."
PAGE = f"""<!DOCTYPE html><html><head><title>t</title><style>p{{x}}</style><script>var a="</p><p>no";</script></head>
<body class="has-sidebar"><header><a href="/">Site</a></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div id="cookie-notice"><p>{PARAGRAPH}</p></div><div class="wrap"><div class="content"><h2>Short  title</h2>
<p>{PARAGRAPH}<br>After &amp; the <b>br</b>eak<p>Second. {PARAGRAPH}<ul><li>one<li>two</ul><!-- <p>gone</p> -->
<div class="advert">Buy, now!</div><form><p>{PARAGRAPH}</p></form><blockquote>Quoted, too. {PARAGRAPH}</blockquote>
<section class="comments"><p>Nice, really. {PARAGRAPH}</p></section></div>
<aside><p>{PARAGRAPH}</p></aside><div class="sidebar"><p>{PARAGRAPH}</p></div></div><footer>&copy; {PARAGRAPH}</footer></body></html>"""


def test_article_without_the_rest():
    blocks = ["Short title", f"{PARAGRAPH} After & the break", f"Second. {PARAGRAPH}", "one", "two", f"Quoted, too. {PARAGRAPH}"]
    assert extract(PAGE) == "\n\n".join(blocks)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("plain &lt;text&gt; &eacute;", "plain <text> é"), ("<p>a<p>b<script>x</p>", "a\n\nb"), ("<nav>x</nav>", ""),
        ("<div>" * 5000 + "deep", "deep"), ("<p title=don't>a<p>b", "a\n\nb"), ("<p>cut off &am", "cut off &am"), ("<p>cut <di", "cut"),
        ("<p>a\u00a0 b</p>\n<p> </p><p>c<br>d</p>", "a b\n\nc d"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<P>X</P><p>Y", "X\n\nY"),
        ("<p>in<i>li</i>ne</p>", "inline"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
    ],
)
def test_small_pages(page, text):
    assert extract(page) == text


def test_long_pages_are_whole():
    page = "<article>" + "".join(f"<p>Paragraph {i}, of many. {PARAGRAPH}</p>" for i in range(3000)) + "</article>"
    assert extract(page).count("\n\n") == 2999


def test_columns_repeated_rows_and_empty_tables(spark):
    rows = [(1, "u", PAGE, "mine", 1), (1, "u", PAGE, "mine", 1), (2, None, None, None, None), (None, "u", "<p>x", "mine", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, N_CHARS int")
    found = extract_text(pages).collect()
    assert [(r["page_id"], len(r["text"]) == r["n_chars"]) for r in found] == [(1, True), (1, True), (2, True), (None, True)]
    assert found[2]["text"] == "" and found[3]["text"] == "x"
    assert extract_text(pages.limit(0)).count() == 0


LONG = " ".join([PARAGRAPH] * 40)


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "{}"])
@pytest.mark.parametrize("tag", ["pre", "blockquote", "section", "li", "div"])
def test_one_dominant_block_drops_nothing_around_it(tag, around):
    page = around.format(f"<h1>Title</h1><p>An intro, short.</p><{tag}>{LONG}</{tag}><p>The end.</p>")
    want = f"Title\n\nAn intro, short.\n\n{LONG}\n\nThe end."
    assert extract(f"<body><nav>menu</nav>{page}<footer>foot</footer></body>") == want


@pytest.mark.parametrize("around", ["<article>{}</article>", "<div class=content>{}</div>", "{}"])
def test_title_beside_the_body(around):
    page = around.format(f"<h1>Title</h1><div class=body><p>{LONG}</p><p>{LONG}</p><ul><li>one</ul></div>")
    assert extract(f"<body><nav>menu</nav>{page}</body>") == f"Title\n\n{LONG}\n\n{LONG}\n\none"


def test_body_split_over_two_containers():
    page = f"<body><div class=a>{f'<p>{PARAGRAPH}</p>' * 12}</div><div class=b><h2>Rest</h2><p>{PARAGRAPH}</p></div></body>"
    assert extract(page) == "\n\n".join([PARAGRAPH] * 12 + ["Rest", PARAGRAPH])


@pytest.mark.parametrize("tag", ["form", "dialog open", "object"])
@pytest.mark.parametrize("article", ["<article><h1>T</h1><p>{0}</p></article>", "<div><h1>T</h1><p>{0}</p></div>"])
def test_wrappers_of_the_whole_page_are_read(tag, article):
    inner = f"<nav>menu</nav>{article.format(LONG)}<footer>foot</footer>"
    assert extract(f"<body><{tag}>{inner}</{tag.split()[0]}></body>") == f"T\n\n{LONG}"


def test_forms_beside_the_article_are_left_out():
    form = f"<form><h1>Sign in</h1><label>Name</label><p>{PARAGRAPH}</p></form>"
    assert extract(f"<body><article><h1>T</h1><p>{LONG}</p>{form}</article>{form}</body>") == f"T\n\n{LONG}"


@pytest.mark.parametrize("label", ["section id=discussion", "section id=related-work", "section class=section-header", "p class=notice"])
def test_labels_that_name_parts_of_an_article(label):
    tag = label.split()[0]
    inner = PARAGRAPH if tag == "p" else f"<h2>Part</h2><p>{PARAGRAPH}</p>"
    page = f"<article><h1>T</h1><p>{PARAGRAPH}</p><{label}>{inner}</{tag}><p>Last. {PARAGRAPH}</p></article>"
    assert PARAGRAPH in extract(page).split("Last.")[0].split(PARAGRAPH, 1)[1]


@pytest.mark.parametrize("label", ["related-posts", "share", "comments", "discussion-comments", "cookie-notice"])
def test_labels_of_links_and_of_others_are_left_out(label):
    links = "<ul>" + "".join(f"<li><a href=/{i}>Another page, {i}</a>" for i in range(5)) + "</ul>"
    inner = links if label in ("related-posts", "share") else f"<p>{PARAGRAPH}</p>"
    page = f"<article><h1>T</h1><p>{LONG}</p><div class={label}>{inner}</div></article>"
    assert extract(page) == f"T\n\n{LONG}"


@pytest.mark.parametrize("label", ["post comments-open", "comment-off", "login-guide", "social-history", "no-sidebar", "search-engines"])
@pytest.mark.parametrize("title", ["<h1>T</h1>", ""])
def test_words_in_passing_do_not_make_a_label(label, title):
    page = f"<body><nav>menu</nav><div class='{label}'>{title}<p>{LONG}</p><p>{PARAGRAPH}</p></div><footer>&copy; 2024</footer></body>"
    assert extract(page) == "\n\n".join((["T"] if title else []) + [LONG, PARAGRAPH])


def test_part_of_an_article_with_words_in_passing():
    page = f"<article><h1>T</h1><p>{PARAGRAPH}</p><div class=social-history><p>{LONG}</p></div></article>"
    assert extract(page) == f"T\n\n{PARAGRAPH}\n\n{LONG}"


@pytest.mark.parametrize("label", ["comments-area", "sidebar-right", "ad-slot", "siteFooter", "newsletter-box", "main-nav", "comment-list"])
def test_words_of_the_layout_do_not_hide_a_label(label):
    page = f"<body><div class=content><h2>T</h2><p>{LONG}</p></div><div class='{label}'><p>{PARAGRAPH}</p></div></body>"
    assert extract(page) == f"T\n\n{LONG}"


@pytest.mark.parametrize("attributes", ['data-state="is hidden now"', "title=hidden", "class=hidden-gems", "data-hidden=1", "style='display:block'", 'aria-hidden="false"'])
def test_values_do_not_hide(attributes):
    assert extract(f"<article><p>{PARAGRAPH}</p><p {attributes}>Seen. {PARAGRAPH}</p></article>").endswith(f"Seen. {PARAGRAPH}")


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN=''", "aria-hidden=true", "style='color:red; display : none'"])
@pytest.mark.parametrize("tag", ["p", "div", "span"])
def test_hidden_elements(tag, attributes):
    assert extract(f"<article><p>{LONG}</p><{tag} {attributes}>Not seen. {PARAGRAPH}</{tag}></article>") == LONG


@pytest.mark.parametrize(
    "inline",
    ["<video src=a>no video</video>", "<svg viewBox=1><path d=1 /><text>words</text></svg>", "<span class=advert>Buy <b>now</b></span>",
     "<span hidden>secret</span>", "<a class=share href=/x>Share</a>", "<audio>none</audio>", "<canvas>none</canvas>"],
)
def test_inline_elements_that_are_no_content(inline):
    label = "article" if "share" not in inline else "div"
    assert extract(f"<{label}><p>Before {inline}after. {LONG}</p><p>{PARAGRAPH}</p></{label}>") == f"Before after. {LONG}\n\n{PARAGRAPH}"


def test_related_story_in_an_article_of_its_own():
    story = f"<article><h2>Another story</h2><p>{PARAGRAPH}</p></article>"
    assert extract(f"<body><article><h1>T</h1><p>{LONG}</p></article>{story}</body>") == f"T\n\n{LONG}"
    both = extract(f"<body><article><h2>A</h2><p>{LONG}</p></article><article><h2>B</h2><p>{LONG}</p></article></body>")
    assert both == f"A\n\n{LONG}\n\nB\n\n{LONG}"


@pytest.mark.parametrize("depth", [100, 511, 512, 513, 600, 3000])
def test_marks_hold_at_any_depth(depth):
    inner = f"<nav>menu</nav><p>{PARAGRAPH}</p><div class=sidebar><div><p>{PARAGRAPH}</p></div></div><p>End, here.</p><footer>foot</footer>"
    assert extract("<div>" * depth + inner + "</div>" * depth + "<nav>menu</nav>") == f"{PARAGRAPH}\n\nEnd, here."


def test_deep_pages_take_linear_time():
    start = time.perf_counter()
    extract("<div>" * 200_000 + "deep" + "</div>" * 200_000)
    extract("<span>" * 100_000 + "<h1>deep</h1>" * 1_000)
    assert time.perf_counter() - start < 20


def plain_ratios(blocks, share):
    """Tag-path ratios as in the docstring, without any tables shared between paths."""
    ratio = []
    for path, _, _ in blocks:
        of = [(text, linked) for p, text, linked in blocks if p == path]
        chars, marks = sum(len(t) for t, _ in of), sum(len([c for c in t if c in ".,;:!?"]) for t, _ in of)
        linked = sum(min(x, len(t)) for t, x in of)
        ratio.append((chars / len(of)) ** 0.5 * (1 + math.log(1 + marks / len(of))) * (1 - linked / max(chars, 1)))
    smooth = []
    for i in range(len(blocks)):
        near = {k: w for k, w in zip(range(i - 2, i + 3), (0.25, 0.5, 1, 0.5, 0.25), strict=True) if 0 <= k < len(blocks)}
        smooth.append(sum(w * ratio[k] for k, w in near.items()) / sum(near.values()))
    fused = []
    for i, (path, _, _) in enumerate(blocks):
        own = [smooth[j] for j, b in enumerate(blocks) if b[0] == path]
        fused.append(0.7 * ratio[i] + 0.3 * sum(own) / len(own))
    typical = sum(f * len(t) for f, (_, t, _) in zip(fused, blocks, strict=True)) / max(sum(len(t) for _, t, _ in blocks), 1)
    kept = set()
    for f, (path, _, _) in zip(fused, blocks, strict=True):
        of = [(len(t), min(x, len(t))) for p, t, x in blocks if p == path]
        if f >= share * typical * (1 - 1e-12) and sum(x for _, x in of) <= 0.5 * sum(n for n, _ in of):
            kept.add(path)
    return kept


def test_content_paths_equal_a_plain_version():
    rng = random.Random(3)
    for _ in range(200):
        blocks = [
            (rng.choice("abcde"), "x" * rng.randint(0, 60) + ".," * rng.randint(0, 3), rng.choice([0, 0, 5, 50])) for _ in range(rng.randint(0, 25))
        ]
        assert content_paths(blocks) == plain_ratios(blocks, 0.3)
