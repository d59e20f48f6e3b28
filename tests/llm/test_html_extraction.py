import pytest

from skyledger.llm import html_extraction
from skyledger.llm.html_extraction import extract, main_text

PROSE = "The ship left the harbour in the morning, and nobody knew why; it was raining. "


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("   \n", ""),
        ("<nav>only a menu</nav>", ""),
        ("<p>Some text &amp; more&nbsp;text.<br>Same  \n block", "Some text & more text. Same block"),
        (f"<body><nav><a href=x>Home</a></nav><div class=ad>Buy, now!</div><article><h1>A title</h1><p>{PROSE}<p>Short.</article><footer>&copy; x.</footer>", f"A title\n{PROSE.strip()}\nShort."),
        (f"<html><head><title>t</title><style>p{{}}</style><body><div id=main><p>{PROSE}</p><script>var a='</p><p>';</script><p>{PROSE}</p></div><div class='comments'><p>{PROSE}</p></div>", f"{PROSE.strip()}\n{PROSE.strip()}"),
        (f"<article><header><h1>T</h1></header><p>{PROSE}</p><aside>{PROSE}</aside><form>{PROSE}<input></form><ul><li>one<li>two</ul></article>", f"T\n{PROSE.strip()}\none\ntwo"),
        (f"<div class='cookie-notice'>{PROSE * 9}</div><main><p>{PROSE}</p></main>", PROSE.strip()),
        ("<p><b>Bold.<br><p>Next &#233; &lt;tag&gt;</p>", "Bold.\nNext é <tag>"),
        ("<!-- <p>no</p> --><p>yes<!-- open", "yes"),
        ('<p title="a > b">quoted</p><p title="open>next</p>', "quoted\nnext"),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


BODY = f"<h1>T</h1><p>{PROSE}</p><p>{PROSE}</p>"
READ = f"T\n{PROSE.strip()}\n{PROSE.strip()}"
SIDE = f"<div class='sidebar'><p>{PROSE}</p></div>"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div class='content-sidebar-wrap'><main><article>{BODY}</article></main>{SIDE}</div>", READ),
        (f"<div class='content-sidebar-wrap'><article>{BODY}</article>{SIDE}</div>", READ),
        (f"<div class='layout has-sidebar'><div>{BODY * 2}</div>{SIDE}</div>", f"{READ}\n{READ}"),
        (f"<div id='search'>{BODY}</div>", READ),
        (f"<div class='wrap no-comments'><article>{BODY}</article></div><div>Some line.</div>", READ),
        (f"<body><form action=x><nav><a href=x>Home</a></nav><div class='login'>Log in</div><div id=c>{BODY}</div><input></form>", READ),
        (f"<form><div class='layout has-sidebar'><article>{BODY}</article>{SIDE}</div></form>", READ),
        # marks that stay
        (f"<div>{BODY}</div><div class='comments'><article>{PROSE * 9}</article><article>{PROSE * 9}</article></div>", READ),
        (f"<div>{BODY}</div><div class='sidebar'><article>{PROSE}</article></div>", READ),
        (f"<main>{BODY}</main><div class='sidebar'>{PROSE * 20}</div>", READ),
        (f"<article>{BODY}<form>{PROSE}</form></article>", READ),
        (f"<div hidden><main>{BODY}</main></div>", ""),
        ("<div class='menu'><a href=x>One</a><a href=y>Two</a></div>", ""),
    ],
)
def test_layouts_named_like_something_else_keep_their_text(page, text):
    assert main_text(page) == text


LONG = f"<p>{PROSE}</p>" * 9
ALL = "\n".join(["T"] + [PROSE.strip()] * 10)
MENU = "<div><a href=x>Home</a> <a href=y>Away</a></div>"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body>{MENU}<article><h1>T</h1><p>{PROSE}</p><div class=body>{LONG}</div></article></body>", ALL),
        (f"<main><div><h1>T</h1></div><p>{PROSE}</p>" + f"<section>{LONG[: len(LONG) // 3]}</section>" * 3 + "</main>", ALL),
        (f"<article><h1>T</h1><p>{PROSE}</p><article><div>{LONG}</div></article></article>", ALL),
        (f"<body>{MENU}<div><h1>T</h1><p>{PROSE}</p><div><div>{LONG}</div></div></div>{MENU}</body>", ALL),
        (f"<body><div>{MENU}<div><h1>T</h1><div><p>{PROSE}</p>{LONG}</div></div></div></body>", ALL),
        # what does not pass is not climbed to
        (f"<body><div><div>Home</div><div>Some words on a line</div><div><div><div><h1>T</h1><p>{PROSE}</p>{LONG}</div></div></div></div>", ALL),
    ],
)
def test_title_and_lede_outside_the_longest_part_are_kept(page, text):
    assert main_text(page) == text


def test_generated_pages_give_their_article(table):
    import html
    import re

    for r in extract(table("pages")).join(table("pages").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(p for p in parts if p)
        assert r["n_chars"] == len(r["text"])


def test_awkward_pages(spark):
    rows = [(1, "u", None, 5), (None, None, "", 5), (2, "u", "<p>" * 3000 + "deep, very. " * 9, 5), (2, "u", "<p>x</p>" * 20_000, 5), (2, "u", "<p>x</p>" * 20_000, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = extract(pages).collect()
    assert [(r.page_id, r.n_chars) for r in got] == [(1, 0), (None, 0), (2, 107), (2, 39_999), (2, 39_999)]
    assert extract(pages.limit(0)).collect() == []


LONG = "Long prose, with some commas and a stop. " * 8
LOOSE = f"<article><h1>T</h1><p>{LONG}</p><div>Tags</div><div>Print</div><p>Short.</p><ul><li>an item</li></ul></article>"


def test_paths_inside_an_article_go_by_their_ratio(monkeypatch):
    kept = f"T\n{LONG.strip()}\nShort.\nan item"
    assert html_extraction.main_text(LOOSE) == kept
    monkeypatch.setattr(html_extraction, "path_ratios", lambda pieces: {p.path: 1.0 for p in pieces})
    assert html_extraction.main_text(LOOSE) == kept.replace("\nShort", "\nTags\nPrint\nShort")


@pytest.mark.parametrize("name", ["article", "main", "div"])
def test_unmarked_short_blocks_beside_prose(name):
    page = f"<body><div>Home</div><div>About</div><{name}><h2>Title</h2><p>{LONG}</p><p>{LONG}</p><section>12 views</section></{name}><div class='user-feedback'><p>{LONG}</p></div></body>"
    assert html_extraction.main_text(page) == "\n".join(["Title", LONG.strip(), LONG.strip()])


def test_path_ratios_equal_sums_by_hand():
    import math
    import random

    dice = random.Random(6)
    paths = [("body",), ("body", "p"), ("body", "div"), ("body", "div", "p"), ("body", "ul", "li")]
    pieces = []
    for _ in range(60):
        text = "".join(dice.choice("ab .,!") for _ in range(dice.randint(1, 80)))
        pieces.append(html_extraction.Piece(dice.choice(paths), False, [text], dice.randint(0, len(text))))
    order = list(dict.fromkeys(p.path for p in pieces))
    fused = []
    for path in order:
        own = [p for p in pieces if p.path == path]
        length = sum(len(p.text[0]) - p.linked for p in own) / len(own)
        marks = (sum(c in ".,!" for p in own for c in p.text[0]) + 1) / len(own)
        fused.append(math.sqrt(length * marks))
    want = {}
    for i, path in enumerate(order):
        before, after = fused[max(i - 1, 0)], fused[min(i + 1, len(order) - 1)]
        want[path] = math.sqrt(fused[i] * (before / 4 + fused[i] / 2 + after / 4))
    got = html_extraction.path_ratios(pieces)
    assert got.keys() == want.keys() and all(math.isclose(got[p], want[p]) for p in want)
