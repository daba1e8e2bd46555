import random
import time

import pytest

from lakewright.llm import html_blocks as h

LONG = "The house stood on the hill and it was there for as long as any of the people in the town could say."
PAGES = {
    None: "",
    "": "",
    "<p>": "",
    f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><a href=x>Home</a></nav><article><h1>A  &amp;\n B</h1><p><b>One<br><p>Two &lt;p&gt;</p></article><footer>f</footer>": "A & B\n\nOne\n\nTwo <p>",
    f"<body><header>top</header><div class='side-bar menu'>m</div><div><h2>Short head</h2><p>{LONG}</p></div><div class=ad>buy</div><form>Name</form></body>": f"Short head\n\n{LONG}",
    f"<article><p>{LONG}</p><div id=comments><p>{LONG}</p></div><section class='cookie-notice'>c</section><p>End.</p></article>": f"{LONG}\n\nEnd.",
    f"<div>{LONG}</div><div><a href=1>{LONG}</a></div>": LONG,
    f"<main><script>var a = '<p>{LONG}</p>';</script><!-- <p>{LONG}</p> --><p>Caf&eacute; a<sub>1</sub></p></main>": "Café a1",
    "<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>": "one\n\ntwo\n\nx\n\ny",
    "<article><p>a < b and c</p></article>": "a < b and c",
    "<article><aside>no</aside><p>yes</p><div hidden>no</div></article>": "yes",
}


@pytest.mark.parametrize("page", PAGES)
def test_pages(page):
    assert h.main_text(page) == PAGES[page]


def test_second_pass_inherits():
    page = f"<div><p>Near one.</p><p>{LONG}</p><p>Near two.</p></div><div><a href=1>Link to something else here</a></div><p>Far.</p>"
    assert h.main_text(page) == f"Near one.\n\n{LONG}\n\nNear two."


def test_query_keeps_every_row(spark):
    rows = [(k, f"u{k}", p, "x") for k, p in enumerate(PAGES)] + [(0, "u0", None, "x"), (None, None, "<article>t</article>", "x")]
    out = h.query(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(out) == len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    assert h.query(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_linear_time():
    start = time.time()
    for page in ("<" * 200_000, "<div " * 30_000, "<b>" * 50_000 + "x</i>" * 50_000, "<a '" * 30_000, "<!--" * 50_000, "<script>" * 20_000, "<p>word " * 50_000, "&" * 100_000):
        h.main_text(page)
    assert time.time() - start < 20


def test_end_tags_find_their_element_at_any_depth():
    rows = "<tr><td>cell<td>cell" * 300
    assert h.main_text(f"<aside><table>{rows}</table></aside><p>{LONG}</p>") == LONG
    assert h.main_text(f"<aside><table>{rows.replace('cell', '<b>cell')}</aside><p>{LONG}</p>") == LONG
    for name in ("nav", "header", "form"):
        assert h.main_text(f"<{name}>{'<div>x' * 500}</{name}><p>{LONG}</p>") == LONG


def test_rows_and_items_end_their_siblings():
    assert h.main_text("<article><table><tr class=ad><td>no<tr><td>yes</table></article>") == "yes"
    assert h.main_text("<article><ul><li class=ad><p>no<li>yes<ul><li>in</ul></ul></article>") == "yes\n\nin"


def test_case_of_end_tags():
    assert h.main_text(f"<p>İİİ</p><main><script>var x = 1</SCRIPT ><p>{LONG}</p></main>") == LONG
    assert h.main_text(f"<main>İ<style>p {{}}</StYle>{LONG}</main>") == f"İ{LONG}"
    assert h.main_text(f"<main><script>a = '</ſcript>';</script>{LONG}</main>") == LONG


def test_optional_tags_and_open_elements():
    assert h.main_text(f"<html><head><title>t</title><meta charset=x><p>{LONG}") == LONG
    assert h.main_text(f"<article>{'<div>' * 1000}<p>{LONG}</p>") == LONG
    assert h.main_text(f"<article><select><option>a<option>b</select><noscript>no</noscript><p>{LONG}</p></article>") == LONG


def test_headings_and_headers_of_the_article():
    head = "A title of the text"
    assert h.main_text(f"<article><h1 class=post-header>{head}</h1><p>{LONG}</p></article>") == f"{head}\n\n{LONG}"
    assert h.main_text(f"<article><header><h1>{head}</h1></header><p>{LONG}</p></article>") == f"{head}\n\n{LONG}"
    assert h.main_text(f"<body><div class=header><h1>{head}</h1></div><h2 class=comments>Five</h2><p>{LONG}</p>") == LONG


LINKS = "<p>" + " ".join(f"<a href={k}>Another story of the day number {k}</a>" for k in range(6)) + "</p>"
DENSE = "<p>" + LONG * 3 + "</p>"
SPARSE = "<p><a href=1>Buy</a> " + "cheap watches bags shoes rings best price fast shipping " * 4 + "</p>"


def test_the_rules_decide(monkeypatch):
    inside = f"<article>{DENSE}{LINKS}{DENSE}</article>"
    plain = f"<body><div>{DENSE}</div><div>{SPARSE}</div><div>{DENSE}</div><div>{LINKS}</div></body>"
    assert h.main_text(inside) == h.main_text(plain) == f"{LONG * 3}\n\n{LONG * 3}"
    monkeypatch.setattr(h, "INSIDE_LINKS", 2)
    assert "Another story" in h.main_text(inside)
    monkeypatch.setattr(h, "MAX_LINKS", 2)
    assert "Another story" in h.main_text(plain) and "watches" not in h.main_text(plain)
    monkeypatch.setattr(h, "stop_density", lambda text: 0.2)
    assert "watches" in h.main_text(plain)
    teasers = "".join(f"<article><p><a href={k}>Another story of the day number {k}</a></p></article>" for k in range(5))
    monkeypatch.undo()
    assert h.main_text(f"<body>{teasers}<div>{DENSE}</div></body>") == LONG * 3  # tags do not make links the text


def test_other_languages():
    text = "東京は日本の首都であり、世界でも最大級の都市のひとつである。" * 6
    assert h.main_text(f"<body><div>{text}</div></body>") == text


def labelled(r):
    """A page and its main blocks, in one of several layouts."""
    words = "the of and to in that it was for on are with as his they at be this from have".split()
    prose = lambda n: " ".join(r.choice(words) if r.random() < 0.4 else "".join(r.choice("abcdeilmnorst") for _ in range(r.randint(3, 9))) for _ in range(n)).capitalize() + "."
    link = lambda: f"<a href='/{r.random()}'>{prose(r.randint(1, 4))}</a>"
    main, body = [], ""
    for k in range(r.randint(3, 9)):
        x = prose(r.randint(4, 9) if k == 0 or r.random() < 0.2 else r.randint(15, 90))
        main.append(x)
        tag = "h2" if k == 0 else r.choice(["p", "p", "p", "blockquote", "div"])
        body += f"<{tag}>{x}</{tag}>"
        if r.random() < 0.15:
            body += f"<ul>{''.join(f'<li>{link()}</li>' for _ in range(5))}</ul>"
    menu = f"<ul>{''.join(f'<li>{link()}</li>' for _ in range(r.randint(3, 12)))}</ul>"
    menu = r.choice([f"<nav>{menu}</nav>", f"<div class=menu>{menu}</div>", f"<div>{menu}</div>", f"<table><tr><td>{menu}</table>"])
    after = r.choice([f"<footer><p>{prose(20)}</p></footer>", f"<div id=comments><p>{prose(30)}</p></div>", f"<aside>{prose(25)}</aside>", f"<div>{link()} {link()} {link()} &copy; 2020</div>", ""])
    frame = r.choice(["<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "<div>{}</div>", "<table><tr><td>{}</table>"])
    return f"<html><head><title>t</title></head><body>{menu}{frame.format(body)}{after}</body></html>", main


def test_recall_and_precision_on_labelled_pages():
    r = random.Random(8)
    right = said = true = 0
    for _ in range(400):
        page, main = labelled(r)
        got = h.main_text(page).split("\n\n")
        right += len(set(got) & set(main))
        said += len(got)
        true += len(main)
    print(f"recall {right / true:.3f}, precision {right / said:.3f}")
    assert right / true > 0.95 and right / said > 0.95


@pytest.mark.parametrize("page", [
    "<div class='content-sidebar-wrap'><main><article>{}</article></main></div>",
    "<div class='layout has-sidebar'><article>{}</article></div>",
    "<article><div class='elementor-widget-container'>{}</div></article>",
    "<div id='page' class='site no-header-image'><article>{}</article></div>",
    "<div id='search-results-page'><article>{}</article></div>",
    "<form id='aspnetForm'><div>{}</div></form>",
    "<form id='aspnetForm'><nav>menu</nav><div class='main-content'>{}</div><footer>foot</footer></form>",
    "<div class='sidebar'><main>{}</main></div>",
    "<div class='page widget'><div>{}</div></div><div><a href=x>other</a></div>",
    "<div class='modal'><div class='comments-area'><p>Nice and it is.</p></div><article>{}</article></div>",
    "<div class='ad-free'>{}</div>",
])
def test_wrappers_keep_their_text(page):
    """Wrappers whose names hold a hint, and forms around the page."""
    for inner in (f"<p>{LONG}</p><p class='ad-free intro'>Short text.</p><p>{LONG}</p>", f"<p>{LONG} {LONG} {LONG}</p><div class='ad-slot'><p>{LONG}</p></div><form><p>Name and address of you</p></form>"):
        want = f"{LONG}\n\nShort text.\n\n{LONG}" if "intro" in inner else f"{LONG} {LONG} {LONG}"
        assert h.main_text(page.format(inner)) == want


def test_a_short_article_does_not_hide_a_long_text():
    assert h.main_text(f"<article><p>Tiny item.</p></article><div><p>{LONG}</p><p>{LONG}</p></div>").count(LONG) == 2
    assert h.main_text(f"<article><p>{LONG}</p></article><div><p>The text beside it is and was of no use to the one in it, as it is here.</p></div>") == LONG


def test_comments_stay_out_however_long():
    assert h.main_text(f"<div><p>{LONG}</p></div><div id='comments'><p>{LONG} {LONG}</p><article class='comment-body'><p>{LONG}</p></article></div>") == LONG
