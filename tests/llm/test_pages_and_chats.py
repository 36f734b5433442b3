"""HTML extraction and chat formatting: round trips, hand-made pages and odd inputs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from assayer.llm import chat_format, html_text

PAGE = '<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">menu word</a></li></ul></nav><!-- ad --><div class="ad">Buy this now</div><article><h1>Head &amp; shoulders</h1><p><b>First line.<br><p>Second  para&nbsp;graph\nof text.</p><div class="ad">inner advert</div><ul><li>one<li>two</ul></article><div id="comments"><p>Nice post</p></div><footer>&copy; host</footer></body></html>'
WANT = "Head & shoulders\nFirst line.\nSecond para graph of text.\none\ntwo"


@pytest.fixture(scope="module")
def weights():
    return html_text.Weights([PAGE] * 3)


def test_best_run_is_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        xs = [rng.randint(-5, 5) for _ in range(12)]
        lo, hi = html_text.best_run(xs)
        assert sum(xs[lo:hi]) == max([0, *(sum(xs[a:b]) for a, b in itertools.combinations(range(13), 2))])


def test_pages(weights):
    assert html_text.extract(PAGE, weights) == WANT
    assert html_text.extract(PAGE, html_text.Weights([])) == WANT
    cut = PAGE[: PAGE.index("</body>")]
    assert html_text.extract(cut, weights) == WANT  # unclosed
    soup = '<div id="top-nav"><a>Home</a></div><div class=content><h1>Title</h1><p>One two three four<p>Five &lt;six&gt;<script>x</script> seven</div><div class="sidebar">side</div><form><label>Mail</label></form>'
    assert html_text.extract(soup, weights) == "Title\nOne two three four\nFive <six> seven"
    assert [html_text.extract(x, weights) for x in (None, "", "<p></p>", "<nav>only menu</nav>")] == [""] * 4
    assert html_text.extract("plain text only", weights) == "plain text only"
    assert len(html_text.extract("<article>" + "<p>word word</p>" * 20_000 + "</article>", weights).split("\n")) == 20_000


@pytest.mark.parametrize("kept", ['<div style="overflow:hidden">in it</div>', '<p><a href="/hidden-valley">in it</a></p>', '<p title="The hidden costs">in it</p>', '<p aria-hidden="false">in it</p>', '<p data-x="display:none">in it</p>', '<section id="discussion"><p>in it</p></section>', '<h2 id="search-trees">in it</h2>', '<div class="related-work">in it</div>', "<p><math><mi>in</mi> <mo>it</mo></math></p>", "<p><svg><text>in it</text></svg></p>"])
def test_no_text_goes_for_a_likeness_of_names(weights, kept):
    assert html_text.extract(f"<article><p>One two three.</p>{kept}<p>Four five six.</p></article>", weights) == "One two three.\nin it\nFour five six."


@pytest.mark.parametrize("gone", ["<p hidden>out</p>", "<p hidden=''>out</p>", '<p aria-hidden="true">out</p>', '<p style="color:red; display: none">out</p>', '<div class="x ad">out</div>', '<div id="left-sidebar">out</div>', '<div role="search">out</div>', '<ul class="topNav"><li>out</li></ul>', '<div id="footer">out</div>'])
def test_hidden_and_named_boilerplate_goes(weights, gone):
    assert html_text.extract(f"<article><p>One two three.</p>{gone}<p>Four five six.</p></article>", weights) == "One two three.\nFour five six."


@pytest.mark.parametrize("name", ["content with-sidebar", "no-comments", "has-nav", "main sidebar-open", "page"])
def test_a_layout_named_after_its_parts_is_kept(weights, name):
    page = f'<body><nav><a>Home</a></nav><div class="{name}"><h1>Title here</h1><p>One two three.</p><div class="sidebar"><p>aside text</p></div><p>Four.</p></div></body>'
    assert html_text.extract(page, weights) == "Title here\nOne two three.\nFour."
    bare = f'<div class="{name}"><p>One two three four five.</p><p>Six.</p></div>'
    assert html_text.extract(bare, weights) == "One two three four five.\nSix."


def test_quotes_count_after_an_equals_sign_only(weights):
    page = "<article><p title='it's'>First real words here.</p><p>It isn't gone, is it?</p><p data-a=\"x > y\" b='>'>last</p><p class=\"open>not closed</p></article>"
    assert html_text.extract(page, weights) == "First real words here.\nIt isn't gone, is it?\nlast\nnot closed"


def test_titles_forms_and_frames(weights):
    assert html_text.extract("<header>Site name</header><article><header><h1>Own title</h1></header><p>Words of it.</p><footer>by me</footer></article>", weights) == "Own title\nWords of it."
    assert html_text.extract("<body><form id=all><nav>menu</nav><div><h1>Title</h1><p>Some words in a form.</p></div></form></body>", weights) == "Title\nSome words in a form."
    comments = "<main><h1>Title</h1><p>Some words.</p></main><section class=comments>" + "<article><p>a long opinion of someone about it</p></article>" * 30 + "</section>"
    assert html_text.extract(comments, weights) == "Title\nSome words."


def test_the_best_run_decides(weights):
    """Without any mark or name, the weights of words and tags choose the region."""
    links = "<div>" + "<div><a>one</a></div>" * 8 + "</div>"
    page = f"<body>{links}<div><p>{'many words in a row ' * 9}</p><p>and an end</p></div>{links}</body>"
    assert html_text.extract(page, weights) == ("many words in a row " * 9).strip() + "\nand an end"
    heavy = html_text.Weights([])
    heavy.weights = {"word": 0.01, "div": 5.0, "/div": -0.1, "a": 5.0}
    assert "one" in html_text.extract(page, heavy)


def test_region_is_brute_force():
    """The text of random small pages against a plain reading of the definition: all runs tried, all containers tried."""
    rng = random.Random(21)
    weights = html_text.Weights([])
    weights.weights = {"word": 1.0, "p": -0.7, "/p": -0.7, "div": -1.5, "/div": -1.5, "a": -2.0, "/a": -2.0, "word/boiler": -3.0}
    for _ in range(150):
        def piece(depth: int) -> str:
            kind = rng.choice(["p", "p", "div", "a", "nav", "ad"]) if depth else "div"
            inner = "".join(piece(depth + 1) for _ in range(rng.randint(1, 3))) if kind == "div" and depth < 3 else " ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 5)))
            return f'<div class="ad">{inner}</div>' if kind == "ad" else f"<{kind}>{inner}</{kind}>"

        page = "<body>" + "".join(piece(0) for _ in range(rng.randint(1, 3))) + "</body>"
        tokens, nodes = html_text.parse(page)
        scores = [weights.score(t) for t in tokens]
        n = len(scores)
        best = max([(0.0, 0, 0), *((sum(scores[i:j]), -i, -(j - i)) for i in range(n) for j in range(i + 1, n + 1))])
        lo, hi = -best[1], -best[1] - best[2]
        words = [i for i in range(lo, hi) if tokens[i][0] == "text" and tokens[i][2].stand >= 0]
        want = ""
        if best[0] > 1e-9 and words:
            holders = [x for x in nodes if x.name in html_text.HOLDERS and x.first <= words[0] and words[-1] < x.last]
            home = min(holders, key=lambda x: x.last - x.first)
            blocks, block = [], []
            for kind, value, node in tokens[home.first : home.last]:
                if kind == "text" and node.stand >= 0:
                    block.append(value)
                elif kind == "tag" and value.lstrip("/") in html_text.BLOCKS:
                    blocks.append(block)
                    block = []
            want = "\n".join(x for b in [*blocks, block] if (x := " ".join("".join(b).split())))
        got_lo, got_hi = html_text.best_run(scores)
        assert sum(scores[got_lo:got_hi]) == pytest.approx(best[0])
        if (got_lo, got_hi) == (lo, hi) or not want:
            assert html_text.extract(page, weights) == want, page


def test_a_very_long_conversation_with_clashing_columns(spark):
    rows = [(1, k, "user" if k % 3 else "assistant", f"turn {k} # <x> \\", "formatted", k) for k in range(1500)] + [(2, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, turns long")
    out = chat_format.format_conversations(df).select("conv_id", chat_format.read_turns("formatted").alias("turns"), chat_format.read_loss("formatted", "loss_spans").alias("loss"))
    got = {r.conv_id: r for r in out.collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [r[2:4] for r in rows[:1500]] and list(got[1].loss) == [r[3] for r in rows[:1500] if r[2] == "assistant"]
    assert [(t.role, t.text) for t in got[2].turns] == [("", "")] and list(got[2].loss) == []
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_weights_have_their_signs(weights):
    assert weights.of("word") > 0 and all(w < 0 for k, w in weights.weights.items() if k != "word")


def test_pages_of_a_table(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "y"), (None, "u", "", "z"), (1, "u", PAGE, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html_text.main_text(df, html_text.train(df)).collect()
    assert sorted((r.doc.page_id or 0, r.text) for r in out) == [(0, ""), (1, WANT), (1, WANT), (2, "")]
    empty = df.limit(0)
    assert html_text.main_text(empty, html_text.train(empty)).count() == 0


TRICKY = ["\\### Assistant: </turn> ok", "\\", "\\\\h<#</turn></turn>", "", None, "### user\n", "a\nb", "\\n#", "é😀<"]


def test_chat_round_trip(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "we#ird\n<\\", None]), rng.choice(TRICKY)) for c in range(40) for t in range(rng.randint(1, 7))]
    rows += [(None, 0, "user", "x"), (0, 0, "assistant", "tie"), (0, 0, "assistant", "tie"), (1, None, "user", "no turn")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    out = chat_format.format_conversations(df)
    out = out.select("conv_id", "formatted", "loss_spans", chat_format.read_turns("formatted").alias("turns"), chat_format.read_loss("formatted", "loss_spans").alias("loss")).collect()
    by_conv = {}
    for c, t, r, x in rows:
        by_conv.setdefault(c, []).append((t if t is not None else -(1 << 63), r or "", x or ""))
    assert {r.conv_id for r in out} == set(by_conv)
    for r in out:
        own = sorted(by_conv[r.conv_id])
        assert [(t.role, t.text) for t in r.turns] == [(a, b) for _, a, b in own]
        assert r.loss == [b for _, a, b in own if a == "assistant"]
        assert r.formatted.count("### ") == sum(1 for _ in itertools.groupby(own, key=lambda x: x[1]))
        for s in r.loss_spans:
            assert r.formatted[s.start + s.length :].startswith("</turn>")
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat_format.format_conversations(df).select(F.size(chat_format.read_turns("formatted")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
