import html
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobloom.llm import maintext

SF_DIR = "/root/testdata/sf0.01"
WORDS = frozenset(" ".join(maintext.STOP_WORDS.values()).split())
PROSE = ("The people who were there had seen that it was not the end of the road, and so they went on "
         "with their work until all of it was done and there was no more that they could do for us. ")


def text(page):
    return maintext.main_text(page, WORDS)


def test_article_with_all_around_it():
    page = f"""<!doctype html><html><head><title>T &amp; T</title><style>p{{}}</style>
    <script>var t="<p>no</p>";</script></head><body class="with-sidebar"><header><h1>Site</h1><p>{PROSE}</p></header>
    <nav><ul><li><a href="/a">Home of the</a></li></ul></nav><div class="cookie-notice"><p>{PROSE}</p></div>
    <div class="layout sidebar-left"><article><header><h1>The  <i>title</i>&nbsp;&lt;here&gt;</h1>
    <p class="byline">By someone</p></header><p>{PROSE}<br>Next line</p><p>Short one.<p>Unclosed &eacute;
    <div class="ad">{PROSE}</div><ul><li>item of one</li><li>item two</li></ul>
    <table><tr><td>xq | zz</td></tr></table><form><label>Name</label><input></form>
    <aside>{PROSE}</aside></article></div><section id="comments"><article class="comment"><p>{PROSE}</p></article></section>
    <div style="display: none">{PROSE}</div><footer>&copy; {PROSE}</footer></body></html>"""
    prose = PROSE.strip()
    assert text(page).split("\n\n") == [
        "The title <here>", f"{prose} Next line", "Short one.", "Unclosed é", "item of one", "item two", "xq | zz"]


def test_without_article_density_and_neighbours_decide():
    prose = PROSE.strip() + " " + PROSE.strip()
    page = (f"<body><div><a href=1>one</a> <a href=2>two</a></div><h2>A heading</h2><p>{prose}</p><p>Short.</p>"
            f"<p>{prose}</p><div>qq zz {'xq ' * 90}</div><p>Terms</p><div><a href=3>{prose}</a></div></body>")
    assert text(page).split("\n\n") == ["A heading", prose, "Short.", prose]


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!-- open", "<script>x", "<div class=\"a",
                                  "</p></div></body>", "<a href='x'>menu</a>"])
def test_nothing_to_find(page):
    assert text(page) == ""


def test_broken_and_long_pages():
    assert text(f"<article><p title='a>b' data-x=\"1>2\">{PROSE}<p>Last") == PROSE.strip() + "\n\nLast"
    page = "<article>" + f"<p>{PROSE}</p>" * 5000
    assert text(page).count(PROSE.strip()) == 5000
    assert text("<article>" + "<a \"" * 3000 + f"</a></p><p>{PROSE}</p>").endswith(PROSE.strip())
    assert text(f"<article><p><a href=x>left open</p><p>{PROSE}</p>") == PROSE.strip()


def test_operator(spark):
    rows = [(1, "u", f"<article><p>{PROSE}</p></article>", "x"), (1, "u", f"<article><p>{PROSE}</p></article>", "y"),
            (None, None, None, None), (2, "v", "<nav>a</nav>", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in maintext.extract(pages).collect()), key=str)
    prose = PROSE.strip()
    assert found == sorted([(1, "u", prose, len(prose))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert maintext.extract(pages.limit(0)).count() == 0


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_articles_of_the_test_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    for r in maintext.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?p>|</?h1>", article)
        blocks = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", p))).split()) for p in parts]
        assert r.text == "\n\n".join(b for b in blocks if b)


@pytest.mark.parametrize("value", ["x" * 100_000, "a > b <p> " * 10_000, "it's, \"so\" " * 10_000])
def test_attribute_values_of_any_length(value):
    quoted = html.escape(value, quote=False).replace('"', "&quot;").replace("&gt;", ">").replace("&lt;", "<")
    page = f'<article><img src="data:{quoted}" alt="x"><p>Article text one.</p><p class="b">Text two.</p></article>'
    assert text(page) == "Article text one.\n\nText two."
    other = value.replace("'", "")
    assert text(page.replace(f'"data:{quoted}"', f"'{other}'")) == "Article text one.\n\nText two."


def test_stray_quotes_and_endless_tags():
    assert text(f"<article><p class=b\">One.</p><p 5\" a=x'>{PROSE}</p><p class=\"b>Two.") == (
        f"One.\n\n{PROSE.strip()}\n\nTwo.")
    for piece in ("<a ", "<a", "<a x='>' ", "<a x=\"<b y='>'\" ", "<p x=\"", "</a '"):
        text("<article>" + piece * 50_000)
        text("<article>" + piece * 50_000 + " x='>'")


@pytest.mark.parametrize("link", ["&eacute;" * 6 + "y" * 54, "&#1078;" * 60, "y" * 29 + "\n" + " " * 80 + "y" * 30,
                                  "y" * 29 + "<b>\n  " + " " * 80 + "</b> <br>" + "y" * 30])
def test_links_count_by_their_decoded_text(link):
    shown = " ".join(html.unescape(re.sub("<.*?>", " ", link)).split())
    assert text(f"<article><p>{'q' * 50} {'z' * 49}<a href=x>{link}</a></p></article>") == (
        f"{'q' * 50} {'z' * 49}{shown}")
    assert text(f"<article><p>{'q' * 50}<a href=x>{link}</a></p></article>") == ""


@pytest.mark.parametrize("tag", sorted(maintext.OPAQUE - maintext.RAW))
def test_elements_left_open_do_not_take_the_page(tag):
    assert text(f"<{tag} src=x><article><p>{PROSE}</p></article>") == PROSE.strip()
    assert text(f"<{tag}><article><p>{PROSE}</p><{tag}>x</{tag.upper()} ></article>") == PROSE.strip()
    assert text(f"<article><{tag}><p>{PROSE}</p><{tag}>{PROSE}</{tag}>{PROSE}</{tag}><p>Text.</p></article>") == "Text."
    assert text(f"<article><{tag} />Text." + f"<{tag}>" * 50_000) == "Text."


@pytest.mark.parametrize("tag", sorted(maintext.RAW))
def test_raw_text_left_open_takes_the_page(tag):
    assert text(f"<article><p>Text.</p><{tag}><p>{PROSE}</p></article>") == "Text."


RUSSIAN = ("В начале года он вернулся в город, где не был много лет, и сразу пошёл к дому, в котором они жили с братом. "
           "На улице было тихо, и он не знал, что сказать тем, кто ещё помнил его и ждал от него ответа на старый вопрос. ")
POLISH = ("Na początku roku wrócił do miasta, w którym nie był od wielu lat, i od razu poszedł do domu, gdzie mieszkał z bratem. "
          "Na ulicy było cicho i nie wiedział, co ma powiedzieć tym, którzy jeszcze go pamiętali i na niego czekali. ")
CHINESE = "年初的时候他回到了那个多年没有去过的城市，马上就去了他和他的弟弟住过的房子。街上很安静，他不知道应该对那些还记得他的人说什么。" * 4


def learned(spark, pages):
    return maintext.learn_stop_words(spark.createDataFrame([(p,) for p in pages], "html string").repartition(2))


@pytest.mark.parametrize("prose, language", [(RUSSIAN, "ru"), (POLISH, "pl"), (CHINESE, "zh"), (PROSE * 2, "en"),
                                             (RUSSIAN, None)])
def test_prose_of_any_language_in_plain_blocks(spark, prose, language):
    prose = prose.strip()
    tag = f'<html lang="{language}-x">' if language else "<html>"
    page = (f"{tag}<body><nav>{prose}</nav><div><a href=1>{prose}</a></div><div><p>{prose}</p>"
            f"<div>{prose}</div></div><footer>{prose}</footer></body></html>")
    words = learned(spark, [page] * 3 + [f'<html lang="en"><p>{PROSE}</p></html>'])
    assert maintext.main_text(page, words) == f"{prose}\n\n{prose}"
    # No words are known of the script: density says nothing.
    assert maintext.main_text(page, maintext.StopWords({})) == f"{prose}\n\n{prose}"


def test_wrappers_say_nothing():
    prose = (PROSE + PROSE).strip()
    assert text(f"<form id=f><nav>{prose}</nav><article><p>{prose}</p></article></form>") == prose
    assert text(f"<form id=f><input><div><p>{prose}</p></div><p>{prose}</p></form>") == f"{prose}\n\n{prose}"
    assert text(f"<p>{prose}</p><p>{prose}</p><form>{PROSE}</form>") == f"{prose}\n\n{prose}"
    for names in ("content has-sidebar", "with-sidebar", "main sidebar-left", "no-menu entry"):
        assert text(f'<div class="{names}"><p>{prose}</p></div><div class="sidebar">{prose}</div>') == prose
    for names in ("sidebar-content", "ad-container", "content comments", "main-menu"):
        assert text(f'<div class="{names}"><p>{prose}</p></div>') == ""


def test_one_short_dense_block_is_the_text():
    assert text("<div>It was the end of the road for all of us.</div>") == "It was the end of the road for all of us."
    assert text(f"<nav>{PROSE}</nav><div>{PROSE}</div><footer>{PROSE}</footer>") == PROSE.strip()


def test_stop_words_decide():
    junk = "qq zz " * 60
    page = f"<div>{PROSE * 2}</div><div>{junk}</div>"
    assert text(page) == (PROSE * 2).strip()
    assert maintext.main_text(page, frozenset()) != text(page)


def test_stop_words_against_a_plain_count(spark):
    pages = [f'<html lang="EN-gb"><script>the the the</script><p>{PROSE}</p>', f"<p>{RUSSIAN} and &amp; the</p><!-- the",
             None, "", f'<html class=x lang=en><b>{PROSE}</b> {"y" * 40} <STYLE>p</STYLE>']
    found = learned(spark, pages).groups
    plain = {("en", 0): re.findall("[a-z]+", PROSE.lower()) * 2 + ["y" * 40],
             ("", 4): re.findall("[а-яё]+", RUSSIAN.lower()), ("", 0): ["and", "the"]}
    assert set(found) == set(plain)
    for key, words in plain.items():
        number = {w: words.count(w) for w in words if len(w) <= maintext.LONGEST_STOP}
        best = sorted(number, key=lambda w: (-number[w], w))[:maintext.TOP]
        assert found[key] == (frozenset(best), sum(number[w] for w in best) / len(words))


def plain_labels(blocks):
    """The second pass, block by block."""
    first = [b.label for b in blocks]
    if not any(b.article for b in blocks) and "good" not in first:
        kind = ["likely"] if "likely" in first else ["open"]
        first = ["good" if x in kind and (x == "likely" or b.stops is not None and b.stops >= maintext.DENSE
                                          and len(b.text) > maintext.TINY)
                 else x for b, x in zip(blocks, first)]
    out = []
    for i, b in enumerate(blocks):
        if first[i] in ("good", "bad"):
            out.append(first[i])
            continue

        def nearest(places):
            for j in places:
                if blocks[j].article != b.article:
                    return None
                if first[j] in ("good", "bad") and not blocks[j].barred:
                    return first[j], abs(j - i)
            return None

        left, right = nearest(range(i - 1, -1, -1)), nearest(range(i + 1, len(blocks)))
        seen = {x[0] for x in (left, right) if x}
        if b.article or seen == {"good"} or not seen and first[i] == "likely":
            out.append("good")
        elif seen != {"good", "bad"}:
            out.append("bad")
        else:
            good, bad = (left, right) if left[0] == "good" else (right, left)
            dense = b.stops is not None and b.stops >= maintext.DENSE
            out.append("good" if first[i] == "likely" or good[1] < bad[1] or good[1] == bad[1] and dense
                       or b.heading and good is right and good[1] <= maintext.NEAR else "bad")
    return out


def test_second_pass_against_a_plain_one():
    draw = random.Random(9)
    for _ in range(4000):
        blocks, section = [], 0
        for _ in range(draw.randrange(12)):
            section = draw.choice([section] * 6 + [0, 1])
            b = maintext.Block("x" * draw.choice([3, 50]), 0, draw.random() < 0.2, section if draw.random() < 0.8 else 0, draw.random() < 0.2)
            b.label = "bad" if b.barred else draw.choice(["good", "bad", "open", "open", "likely"])
            b.stops = draw.choice([None, 0.1, 1.0])
            blocks.append(b)
        expected = plain_labels(blocks)
        maintext._second_pass(blocks)
        assert [b.label for b in blocks] == expected


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_articles_without_their_tag(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    plain = pages.withColumn("html", F.regexp_replace("html", "(</?)article>", "$1div>"))
    wanted = {r.page_id: r.text for r in maintext.extract(pages).collect()}
    blocks = missed = more = 0
    for r in maintext.extract(plain).collect():
        want, got = (Counter(x.split("\n\n")) for x in (wanted[r.page_id], r.text))
        blocks += want.total()
        missed += (want - got).total()
        more += (got - want).total()
    assert missed + more <= 0.05 * blocks
