"""Main-text extraction on pages made around known articles: hosts with templates of their own, wrappers, broken and deep markup."""

import random

import pytest

from corpusmill.llm import htmltext as H

RNG = random.Random(11)


def _words(n):
    return " ".join("".join(RNG.choice("abcdefghij") for _ in range(RNG.randrange(2, 9))) for _ in range(n))


def _article():
    blocks = [_words(6).capitalize()] + [_words(RNG.randrange(15, 60)) for _ in range(RNG.randrange(3, 9))]
    return blocks, f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b}" + RNG.choice(["</p>", ""]) + "\n" for b in blocks[1:])


def _junk():
    return RNG.choice([
        "<nav><ul><li><a href=/>Home page link</a><li><a href=/x>More</a></ul></nav>", f"<div class='ad-box'>{_words(12)}</div>",
        f"<aside>{_words(20)}</aside>", f"<div class=cookie-notice><p>{_words(9)}</p></div>", f"<script>var a = '<p>{_words(5)}</p>';</script>",
        f"<form action=/s><input name=q><button>{_words(2)}</button></form>", f"<!-- <p>{_words(4)}</p> -->", f"<p hidden>{_words(6)}</p>"])


TEMPLATES = {
    "a.example": "<html><head><title>t</title></head><body>{0}<div id=top>{1}</div><div class='post-body c{n}'>{art}</div>{2}<footer>{3}</footer></body>",
    "b.example": "<body><table><tr><td class=menu>{0}</td><td class=text>{art}</td></tr></table>{1}<section class=comments><h3>c</h3><p>{c}</p></section>",
    "c.example": "<main class=wide>{0}<article class='entry'>{art}</article></main>{1}<div class='comment-list comments'><p>{c}</p></div>",
    "d.example": "<div class='layout-with-sidebar'><div class=sidebar>{0}</div><div class=col>{art}</div>{1}</div>",
    "e.example": "<form method=post><div class=page>{0}<div class=cell>{art}</div></div><input type=submit></form>",
}


def test_articles_of_five_hosts(spark):
    rows, want = [], {}
    for i in range(150):
        host = list(TEMPLATES)[i % 5]
        blocks, art = _article()
        html = TEMPLATES[host].format(*(_junk() for _ in range(4)), art=art, c=_words(120), n=i)
        rows.append((i, f"https://{host}/p{i}", html))
        want[i] = "\n".join(blocks)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in H.main_texts(pages.repartition(4)).collect()} == want


@pytest.mark.parametrize("titled", [True, False])
@pytest.mark.parametrize("wrapper", [
    "<div class='layout-with-sidebar'>{}</div>", "<div id=main class='sidebar-right'>{}</div>", "<div class='comment-closed post'>{}</div>",
    "<div class='page page-search'><article>{}</article></div>", "<div class='content related-post-open'>{}</div>",
    "<form><div>{}</div></form>", "<div class=search-page><form><div class=widget-area>{}</div></form></div>"])
def test_wrappers_keep_their_article(wrapper, titled):
    body = "<p>" + "Some words of it. " * 20 + "</p><p>" + "And more of them. " * 30 + "</p>"
    inside = ("<h1>Title</h1>" if titled else "") + body + "<div class=sidebar><p>aside text</p></div><div class=comments><p>reader text</p></div>"
    text, _ = H.extract(f"<body><nav>menu</nav>{wrapper.format(inside)}<footer>end</footer></body>", None)
    lines = [" ".join(x.split()) for x in ("Some words of it. " * 20, "And more of them. " * 30)]
    assert text == "\n".join((["Title"] if titled else []) + lines)


def test_doubtful_parts_beside_an_article_stay_out():
    long = "<p>" + "reader words " * 300 + "</p>"
    text, _ = H.extract(f"<div class=story><h1>Title</h1><p>{'short story ' * 9}</p></div><div class=comments>{long}</div>", None)
    assert text == "Title\n" + " ".join(["short story"] * 9)
    text, _ = H.extract(f"<div class=masthead><h1>Site</h1></div><div class=text><h2>Piece</h2><p>{'story ' * 30}</p></div>", None)
    assert text == "Piece\n" + " ".join(["story"] * 30)


def test_deep_and_unclosed_markup():
    assert H.extract("<font>" * 100_000 + "text", None)[0] == "text"
    deep = "".join(f"<div class=c{i}><p>line {i}</b></i>" for i in range(20_000))
    lines = H.extract(deep, None)[0].split("\n")                     # a container and all in it
    assert len(lines) > 1000 and lines == [f"line {i}" for i in range(20_000 - len(lines), 20_000)]
    assert H.extract("<b>" * 50_000 + "x" + "</i>" * 50_000 + "</b>" * 60_000 + "<p>y", None)[0] == "x\ny"


def test_all_classes_and_all_containers_vote(spark):
    nodes, blocks = H.read("<div class='e d c b a f9'><p>word word word</p></div>")
    assert [x.own for x in H.score_containers(nodes, blocks)] == ["div.a.b.c.d.e.f#"]
    html = "<body><div><section><div><article><p>" + "many words " * 50 + "</p></article></div></section></div></body>"
    pages = spark.createDataFrame([(1, "https://h/", html), (2, "https://h/2", None), (3, "https://H/3", html)], "page_id long, url string, html string")
    votes = H.vote(pages).collect()
    assert sorted(r.path[17:] for r in votes) == ["article", "body", "div", "div", "section"] and {r.pages for r in votes} == {2}
    assert {r.host for r in votes} == {"h"}


def test_equal_votes_go_to_the_lesser_path(spark):
    rows = [(i, "https://h/", f"<div class={c}><p>{'same words ' * 9}</p></div>") for i, c in enumerate("xy")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    win = H.winning_paths(H.vote(pages)).collect()
    assert [r.path for r in win] == [min(r.path for r in H.vote(pages).collect())]
    assert len({r.text for r in H.main_texts(pages).collect()}) == 1
