import random
import zlib

import numpy as np
import pytest

from emberline.llm import pages, toxicity

GOOD = "This is the first paragraph of the article and it has many of the words that are in the list."
MORE = "The second paragraph of the article is also long, and there are a number of words in it for the test."


def test_page_without_an_article_element():
    page = f"""<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style></head><body>
    <header class="site-header"><a href="/">Home</a> Welcome to the site of all the things that you want</header>
    <div id="cookie-notice">We use cookies to make the site better for you and for all of us in the world.</div>
    <script>document.write("<p>{GOOD}</p>")</script>
    <div class="content"><h1>A title</h1><p>{GOOD}</p><p>Short one.</p><p>{MORE}</p></div>
    <aside><p>{MORE}</p></aside><ul class="related"><li><a href="/x">Read more of the best of the week on this site</a></ul>
    <div class="comments"><p>I think that this is the best of all that I have read in the past year.</p></div>
    <form>Enter your name <input> to get the news of the day for all of the week</form><footer>&copy; 2020</footer>"""
    assert pages.main_text(page) == f"A title\n{GOOD}\nShort one.\n{MORE}"


def test_broken_markup_references_and_space():
    page = "<nav><a href=x>a</a></nav><article><h1>T &amp; U</h1><p><b>one\n\t two<br>three<br><p>&lt;x&gt; &eacute;&#33;<!-- c --></article><footer>f"
    assert pages.main_text(page) == "T & U\none two three\n<x> é!"
    assert pages.main_text("<article><p>a<script>x</article>") == "a"
    assert pages.main_text('<article class="post"><p title="a>b">x</p></article>') == "x"


def test_article_text_without_stop_words_stays():
    table = " | ".join(f"cell{i}" for i in range(60))
    page = f"<div class='ad'>Buy</div><article><p>{table}</p><p>{table}</p></article><div>outside of the article</div>"
    assert pages.main_text(page) == f"{table}\n{table}"


def test_extract(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "v", "<p>plain"), (2, "u", ""), (5, "w", "<" * 5000 + "'\"" * 3000),
            (6, "x", "<article>" + f"<p>{GOOD}</p>" * 4000)]
    df = spark.createDataFrame([(*r, "t", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = pages.extract(df).collect()
    assert len(got) == 6 and all(g.n_chars == len(g.text) for g in got)
    by_id = {g.page_id: g.text for g in got}
    assert by_id[1] == by_id[2] == "" and by_id[None] == "plain" and by_id[6].count("\n") == 3999
    assert pages.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "wrapper",
    [
        "div class='content has-sidebar'", "div id='page-with-sidebar'", "article class='post comments-open'",
        "section class='news-widget'", "section class='widget'", "div class='sidebar'", "form",
    ],
)
def test_names_of_wrappers_do_not_lose_the_article(wrapper):
    close = wrapper.split()[0]
    for title in ("<h1>A title</h1>", ""):
        page = f"<body><div class='nav'><p>{GOOD}</p></div><{wrapper}>{title}<p>{GOOD}</p><p>{MORE}</p></{close}></body>"
        assert pages.main_text(page) == ("A title\n" if title else "") + f"{GOOD}\n{MORE}"


def test_named_parts_beside_an_article_stay_out():
    beside = "".join(f"<div class='{c}'><p>{MORE}</p></div>" for c in ("comments", "widget-area", "left-sidebar", "ad_300x250"))
    thread = f"<div id='comments'><article class='comment-body'><p>{MORE}</p><p>{MORE}</p><p>{MORE}</p></article></div>"
    assert pages.main_text(f"<article><h1>T</h1><p>{GOOD}</p><p>{MORE}</p></article>{beside}{thread}") == f"T\n{GOOD}\n{MORE}"


def test_links_within_the_article_stay():
    reference = "<li><a href='/a'>Smith and Jones, Measuring distant fires from low orbit, Journal of Heat 12, pages 1-20</a></li>"
    one = "<p><a href='/r'>Download the report</a></p>"
    tags = "".join(f"<li><a href='/t{k}'>tag {k}</a></li>" for k in range(4))
    got = pages.main_text(f"<article><p>{GOOD}</p>{one}<p>{MORE}</p><ol>{reference * 2}</ol><ul>{tags}</ul></article>").split("\n")
    assert got[:3] == [GOOD, "Download the report", MORE] and len(got) == 5 and got[3].startswith("Smith")


def test_running_text_apart_from_an_article_element_stays():
    apart = f"<div><p>{GOOD} {MORE}</p></div>"
    assert pages.main_text(f"{apart}<article><p>{GOOD}</p><p>{GOOD} {MORE}</p></article>").count(MORE) == 2
    card = "<article><p>A card of the shop</p></article>"
    assert pages.main_text(f"<div><p>{GOOD}</p><p>{MORE}</p></div>{card}").startswith(f"{GOOD}\n{MORE}")


@pytest.mark.parametrize("tag", ["button", "select", "object", "audio", "video", "canvas", "svg", "math", "template", "noscript"])
def test_unread_elements_end_with_what_encloses_them(tag):
    assert pages.main_text(f"<article><div><{tag}>x</div><p>{GOOD}</p><p>{MORE}</p></article>") == f"{GOOD}\n{MORE}"
    assert pages.main_text(f"<{tag}>x<article><p>{GOOD}</p><p>{MORE}</p></article>") == f"{GOOD}\n{MORE}"
    later = f"<div><{tag}>y</{tag}></div>"
    assert pages.main_text(f"<article><div><{tag}>x</div><p>{GOOD}</p>{later}<p>{MORE}</p></article>") == f"{GOOD}\n{MORE}"
    assert pages.main_text(f"<article><p>{GOOD} <{tag}>x</p><p>{MORE}</p>{later}</article>") == f"{GOOD}\n{MORE}"
    nested = f"<{tag}>x<{tag}>y</{tag}><div>{MORE}</{tag}>"
    assert pages.main_text(f"<article>{nested}<p>{GOOD}</p></article>") == GOOD


def toy(n, seed):
    r = random.Random(seed)
    rows, marks = [], []
    for k in range(n):
        bad = r.random() < 0.15
        words = [f"w{r.randrange(300)}" for _ in range(r.randrange(20, 120))]
        if bad:
            for _ in range(r.randrange(1, 4)):
                words.insert(r.randrange(len(words)), "mean" + "abc"[r.randrange(3)])
        letters = " ".join(w.translate(str.maketrans("0123456789", "ghijklmnop")) for w in words)
        rows.append((k, letters, "en", "s", int(bad), int(bad)))
        if r.random() < 0.6:
            marks.append((k, 1, int(bad)))
    return rows, marks


@pytest.fixture(scope="module")
def scored(spark):
    rows, marks = toy(1500, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, toxic int, score int")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    return rows, marks, docs, labels, toxicity.toxicity(docs, labels).collect()


def test_held_out_accuracy(scored):
    rows, _, _, _, got = scored
    truth = {r[0]: r[4] for r in rows}
    assert len(got) == len(rows)
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 5 == 0) for g in got)
    held = [g for g in got if g.held_out]
    assert np.mean([g.predicted == truth[g.doc_id] for g in held]) > 0.95
    assert all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.5) for g in got)


def test_held_out_labels_are_not_read(scored, spark):
    _, marks, docs, _, got = scored
    flipped = [(k, q, 1 - t if zlib.crc32(str(k).encode()) % 5 == 0 else t) for k, q, t in marks]
    again = toxicity.toxicity(docs, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int")).collect()
    assert sorted((g.doc_id, g.score) for g in again) == sorted((g.doc_id, g.score) for g in got)


def test_risk_is_corrected_by_the_prior():
    """Unlabelled rows that look like the confirmed ones are not all taken for harmless."""
    r = np.random.default_rng(0)
    word = lambda bad: np.unique(np.append(r.integers(10, 500, 20), [3] if bad else [])).astype(np.int32)
    model = toxicity.train([word(True) for _ in range(200)], [word(r.random() < 0.2) for _ in range(800)], 0.2)
    z = toxicity.sums(np.bincount(model.places, model.weights, toxicity.WIDTH), [word(True), word(False)])
    assert model.score(z)[0] > 0.5 > model.score(z)[1]


def test_awkward_rows(spark, docs, no_docs, rows):
    labels = spark.createDataFrame([(6, 1, None), (7, None, 1), (None, 1, 1), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= g.score <= 1 for g in got)
    assert toxicity.toxicity(no_docs, labels.limit(0)).count() == 0
    assert all(g.predicted == 0 for g in toxicity.toxicity(docs, labels.limit(0)).collect())


ARTICLE = "<p>" + "This is the story of the town and of the people who have lived in it for a long time. " * 3 + "</p>"


@pytest.mark.parametrize(
    "beside",
    [
        "<div class='reader-comments'>{}</div>", "<div class='user-comment'>{}</div>", "<div class='newsletter-signup'>{}</div>",
        "<div class='alert'>{}</div>", "<div id='gdpr-message'>{}</div>", "<div id='ft'>{}</div>", "<div class='story-reply-thread'>{}</div>",
        "<div class='box sign-up'>{}</div>", "<section id='sponsored-stories'>{}</section>",
    ],
)
@pytest.mark.parametrize("around", ["<main>{}</main>", "<article>{}</article>", "<div class='content has-sidebar'>{}</div>"])
def test_named_parts_go_wherever_they_stand(beside, around):
    more = "<p>" + "I think that this is what they have said about it and we are all of the same opinion here. " * 2 + "</p>"
    want = " ".join(pages.main_text(f"<html><body>{ARTICLE}</body></html>").split())
    page = "<html><body>" + around.format(ARTICLE + beside.format(more)) + "</body></html>"
    assert pages.main_text(page) == want
    assert pages.main_text("<html><body>" + around.format(beside.format(more) + ARTICLE) + "</body></html>") == want


@pytest.mark.parametrize("name", ["post comments-open", "newsletter-issue", "consent-page", "content has-sidebar"])
def test_a_name_does_not_remove_what_encloses_the_article(name):
    want = " ".join(pages.main_text(f"<html><body>{ARTICLE}</body></html>").split())
    assert pages.main_text(f"<html><body><div class='{name}'><h1>The town</h1>{ARTICLE}</div></body></html>") == f"The town\n{want}"
    assert pages.main_text(f"<html><body><article class='{name}'>{ARTICLE}</article></body></html>") == want


CLUTTER = [
    "<nav><ul><li><a href='/'>Home</a></li><li><a href='/news'>All the news of the day</a></li></ul></nav>",
    "<header><div class='logo'>The Daily</div><a href='/login'>Log in</a></header>",
    "<aside><h3>More of this</h3><p>These are the stories that other readers have liked the most in the last week of the year.</p></aside>",
    "<footer><p>All rights are with the owners of this site and with no one else in the world of today.</p></footer>",
    "<script>var x = '<p>not a text that is to be read by anyone at all</p>';</script>",
    "<style>p { color: red } /* it is in the style of the house */</style>",
    "<div class='cookie-banner'><p>We and our partners use what we know about you so that we can show you what you want to see.</p></div>",
    "<div class='ad'><p>This is the best of all the offers that you can have from us if you are here by the end of the day.</p></div>",
    "<form><p>Tell us who you are and we will send you all of this to where you want it to be sent to you.</p><input></form>",
    "<section id='comments'><h2>Comments</h2><p>I have to say that this is not what I was told by them when I was there with my friends.</p></section>",
    "<!-- <p>This is what was here before and it is not to be seen by any of the readers of the page.</p> -->",
    "<div class='social-share'><a href='#'>Share</a> <a href='#'>Send it to a friend</a></div>",
    "<ul class='related'><li><a href='/a'>What they have said about it</a></li><li><a href='/b'>And what it is all about</a></li></ul>",
]


@pytest.mark.parametrize("seed", range(40))
def test_generated_pages_give_back_what_they_were_made_of(seed):
    """Articles of known blocks with clutter of all kinds around and between them: the blocks come back, nothing else."""
    r = random.Random(seed)
    words = "the of and to in that it was for on with as at by from they we this have not town river winter story house people".split()

    def sentence():
        own = [r.choice(words) for _ in range(r.randrange(25, 60))]
        return " ".join(own).capitalize() + "."

    blocks, parts = [], []
    for k in range(r.randrange(2, 8)):
        text = sentence()
        plain = text
        if r.random() < 0.3:
            text, plain = text + " Salt &amp; pepper&nbsp;too", plain + " Salt & pepper too"
        if r.random() < 0.3:
            first, rest = text.split(" ", 1)
            text = f"<b>{first}</b>\n\t {rest}"
        tag = r.choice(["p", "p", "p", "div", "blockquote"])
        parts.append(f"<{tag}>{text}</{tag}>")
        blocks.append(plain)
        if r.random() < 0.25 and k:
            parts.append(r.choice(CLUTTER[4:]))
    before, after = ("".join(r.sample(CLUTTER, r.randrange(0, 5))) for _ in range(2))
    around = r.choice(["<main>{}</main>", "<article>{}</article>", "<div class='wrap'><article class='post'>{}</article></div>"])
    html = f"<html><head><title>A page of the site</title></head><body>{before}{around.format(''.join(parts))}{after}</body></html>"
    assert pages.main_text(html) == "\n".join(blocks)
