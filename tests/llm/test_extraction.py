"""The cut against enumeration, and pages with known main text."""

import html
import itertools
import random
import re

from meshfold.llm import extraction


def test_cut_is_minimal():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(0, 8)
        costs = [rng.randint(-9, 9) for _ in range(n)]
        links = [(i, j, rng.randint(0, 6)) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def energy(labels):
            return sum(max(-c, 0) if k else max(c, 0) for c, k in zip(costs, labels)) + sum(w for i, j, w in links if labels[i] != labels[j])

        assert energy(extraction.content_side(costs, links)) == min(map(energy, itertools.product([False, True], repeat=n)))


def test_long_chains():
    rng = random.Random(2)
    costs = [rng.choice([-3, 3]) for _ in range(20_000)]
    assert len(extraction.content_side(costs, [(i, i + 1, 2) for i in range(len(costs) - 1)])) == len(costs)


def test_smoothing_keeps_a_doubtful_block_between_sure_ones():
    sentence = "This paragraph has enough words to be told from a menu, and it closes as sentences do, with a full stop at the end of all."
    page = f"<body><div class=a><a href=/>Home</a><a href=/x>News</a></div><div><p>{sentence}</p><p>Short one</p><p>{sentence}</p></div><div><a href=/1>l1</a></div>"
    assert extraction.main_text(page) == f"{sentence}\nShort one\n{sentence}"


def test_parts_that_go():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li>a<li>b</ul></nav>
    <div class="cookie-notice">We use cookies to make this site better for all of you, please agree.</div><!-- x <p>no</p> --><main><article><header><h1>Title &amp; more</h1></header>
    <p>First&nbsp;para <b>bold</b>
    and   <i>so</i> on.<br>Next.<script>var x = "</p>";</script><p>Second<div class="ad">Buy now, it is cheap and very good indeed.</div><ul><li>one<li>two</ul>
    <form><label>q</label><input name=q></form><table><tr><td>c1<td>c2</table></article><section id="comments"><h2>Comments</h2><p>Great article, thank you for it, I liked all of it.</p></section></main>
    <aside>More</aside><div style="display:none">hidden words</div><footer>&copy; x</footer></body></html>"""
    assert extraction.main_text(page) == "Title & more\nFirst para bold and so on. Next.\nSecond\none\ntwo\nc1\nc2"


def test_broken_pages():
    for page, text in (("", ""), ("<", ""), ("<p", ""), ("<article><p>a &am", "a &am"), ("<article>x</b></p></article></article>", "x"), ("<article><p>1 < 2 & 3", "1 < 2 & 3"),
                       ("<article><script>never closed <p>x", ""), ("<article><p title='a>b'>y", "y"), ("<nav>only</nav>", ""), ("<!-- open", "")):
        assert extraction.main_text(page) == text
    deep = "<div>" * 20_000 + "<article><p>deep</p>"
    assert extraction.main_text(deep) == "deep"


def test_hints_do_not_take_the_article():
    text = "This paragraph has enough words to be told from a menu, and it closes as sentences do, with a full stop at the end of all."
    for page in ("<article class='post category-social'>{}</article>", "<article class='hentry tag-legal'>{}</article>", "<div class='content has-sidebar'>{}</div>",
                 "<main class='no-sidebar'>{}</main>", "<main class='legal'><article id=search>{}</article></main>", "<div class='sidebar-layout'><main>{}</main></div>",
                 "<div class='with_sidebar'><article>{}</article></div>", "<div data-id='search-3' data-class='menu'>{}</div>", "<div alt=\"class='menu' hidden\">{}</div>"):
        assert extraction.main_text(f"<body>{page.format(f'<p>{text}</p>')}<nav>Home</nav></body>") == text, page
    for attribute in ("title='a hidden gem'", "data-hidden", "title=\"style='display:none'\"", "data-x=class=menu"):
        assert extraction.main_text(f"<article><p {attribute}>{text}</p></article>") == text, attribute
    for attribute in ("hidden", "HIDDEN=''", "class='x menu'", "class=site_footer", "id='comments'", "role=navigation", "title='x'hidden", "class='post has-x sidebar'", "style='display: none'"):
        assert extraction.main_text(f"<article><p>{text}</p><div {attribute}>{text}</div></article>") == text, attribute
    assert extraction.main_text(f"<main><p>{text}</p><div id=comments><article>{text}</article></div></main>") == text
    assert extraction.main_text(f"<article>{text}</article><div class=related><article>{text}</article></div>") == text


def test_only_raw_text_ends_at_its_end_tag():
    for name in ("select", "object", "svg", "math", "noscript", "template"):
        assert extraction.main_text(f"<article><p>before</p><{name}><p>after</p></article>") == "before\nafter", name
        assert extraction.main_text(f"<article><p>before <{name}>x</p><p>after</p></article><{name}>y</{name}>").endswith("\nafter"), name
        inside = "a in b" if name == "math" else "a b"
        assert extraction.main_text(f"<article><p>a <{name}>in</{name}> b</p></article>") == inside, name
    assert extraction.main_text("<article><p>a<select><option>x<option>y</select>b</p><noscript><p>on</p></noscript><p>c</p></article>") == "a b\nc"


def test_operator(spark):
    rows = [(1, "u", "<article><p>é</p></article>"), (2, None, None), (2, None, None), (None, "v", "")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    assert sorted(map(tuple, extraction.extract(pages).collect()), key=repr) == sorted([(1, "u", "é"), (2, None, ""), (2, None, ""), (None, "v", "")], key=repr)
    assert extraction.extract(pages.where("page_id = 9")).collect() == []


def test_query_finds_the_articles(spark, sf_small):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    got = extraction.op10_extraction(spark, sf_small).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", pages[r.page_id], re.S)[1]
        inner = re.sub(r"<[^>]*\Z|</?b>", "", inner).replace("<br>", " ")
        blocks = [" ".join(html.unescape(x).split()) for x in re.split("</?p>|</?h1>", inner)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
