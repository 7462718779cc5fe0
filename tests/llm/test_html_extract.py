import html
import re

import pytest

from sensorium.llm import html_extract as H

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return H.train([])


def by_tags(page):
    """The article of the test pages, which all mark it, cut out with plain patterns."""
    article = page[page.index("<article>") + 9:page.index("</article>")]
    blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
    return "\n".join(b for b in blocks if b)


def test_whole_table(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = H.op3_html_extraction(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == by_tags(pages[r.page_id]) and r.n_chars == len(r.text)


def test_pages_of_a_layout_it_was_not_trained_on(model):
    page = """<html><body class="home"><div class="topbar"><span>Sign in</span></div><div id="nav-main"><ul><li><a href=1>One</a>
    <li><a href=2>Two</a></ul></div><div id="wrapper"><div class="story-body"><h1>New school opens</h1><p>The school opened on
    Tuesday with two hundred pupils.<p>Parents were pleased &amp; said so.<ol><li>First lesson at eight.</ol></div>
    <div class="promo"><p>Subscribe now and save half. Only this week.</p></div><div class="user-comments"><p>What a nice
    building, I went there once.</p></div><form><input><p>Tell us what you think. We read everything.</p></form></div>
    <footer><p>All rights reserved. Imprint.</p></footer><script>document.write("<p>x</p>")</script></body></html>"""
    assert H.main_text(page, model) == ("New school opens\nThe school opened on Tuesday with two hundred pupils.\n"
                                        "Parents were pleased & said so.\nFirst lesson at eight.")


def test_held_out_templates():
    """Accuracy on each template's text by a model that hasn't seen it."""
    right = total = 0
    for i in range(len(H._TEMPLATES)):
        page = H.template_page(H._TEMPLATES[i])
        model = H.Model()
        for j, t in enumerate(H._TEMPLATES):
            if i != j:
                nodes = H.parse(H.template_page(t))
                model.learn(nodes, H.labels(nodes, marked=True), weight=50)
        model.finish()
        nodes = H.parse(page)
        state = H.labels(nodes, marked=True)
        for n, p, s in zip(nodes, model.marginals(nodes), state, strict=True):
            if n.kind == H.TEXT:
                right += (p > 0.5) == s
                total += 1
    assert right / total >= 0.9


def test_marginals_equal_enumeration(model):
    """Sum-product against the sum over all states of a small tree."""
    import itertools
    import math
    nodes = H.parse("<html><body><div class=content><p>One sentence here. And more words.</p><p>Two</p></div><ul><li><a>x</a></li></ul></body></html>")
    unary = model.unary(nodes)
    weight = [0.0] * len(nodes)
    total = some = 0.0
    for states in itertools.product((0, 1), repeat=len(nodes)):
        x = sum(unary[i][s] for i, s in enumerate(states))
        x += sum(model.link[states[n.parent]][states[i]] for i, n in enumerate(nodes) if n.parent >= 0)
        x = math.exp(x)
        total += x
        some += x * any(s and n.kind == H.TEXT for s, n in zip(states, nodes, strict=True))
        for i, s in enumerate(states):
            weight[i] += x * s
    assert model.marginals(nodes) == pytest.approx([w / total for w in weight])
    assert model.beliefs(nodes)[1] == pytest.approx(some / total)


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("just text &lt;b", "just text <b"), ("<article><p>A one.  B\n two.</p><p>C&nbsp;d</article>", "A one. B two.\nC d"),
    ("<article><p>Text here. Cut<scri", "Text here. Cut"), ("<article><p>One. Two<br>three</p><!-- no --><script>var a='</p>'</script></article>", "One. Two three"),
    ("<article><p>A < b and c > d.</p></article>", "A < b and c > d."), ("</p></div><article><p>Ends. Fine.</section>", "Ends. Fine."),
    ("<main><p hidden>Secret words. No.</p><p>Open words. Yes.</p></main>", "Open words. Yes.")])
def test_broken_and_odd_markup(model, page, text):
    assert H.main_text(page, model) == text


GOOD = ["The harbour was closed on Monday after a storm, and boats stayed in.", "Nobody was hurt. Work goes on, said the office."]


@pytest.mark.parametrize("depth", [0, 1, 2, 5, 20, 60, 200, 1000, 2000])
def test_depth_says_nothing(model, depth):
    body = "".join(f"<p>{x}</p>" for x in GOOD)
    assert H.main_text("<div>" * depth + body + "</div>" * depth, model) == "\n".join(GOOD)
    menu = "<ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport")) + "</ul>"
    page = "<body>" + menu + "<div>" * depth + body + "</div>" * depth + "<footer>Imprint. Terms.</footer></body>"
    assert H.main_text(page, model) == "\n".join(GOOD)
    # Each level has a menu of its own beside the next one.
    page = ("<div>" + menu) * min(depth, 60) + "<main>" + body + "</main>" + "</div>" * min(depth, 60)
    assert H.main_text(page, model) == "\n".join(GOOD)


ARTICLE = "<h1>Storm</h1>" + "".join(f"<p>{x}</p>" for x in GOOD)


@pytest.mark.parametrize(("inside", "text"), [
    ("<ul><li>One item</li><li>two</li><li>Buy three eggs</li></ul>", "One item\ntwo\nBuy three eggs"),
    ('<ul><li><a href="/a">A link item</a></li><li>two</li><li>Buy three eggs</li></ul>', "A link item\ntwo\nBuy three eggs"),
    ('<p><a href="/r">The full report of the office</a></p>', "The full report of the office"),
    ('<p><a href="/r">Report</a></p>', "Report"),
    ("<table><tr><th>Day</th><td>3.2</td></tr><tr><td>Monday</td><td>x</td></tr></table>", "Day\n3.2\nMonday\nx"),
    ("<h2>Then</h2><ol><li>x</li></ol><dl><dt>Term</dt><dd>meaning</dd></dl>", "Then\nx\nTerm\nmeaning"),
    ("<blockquote>So be it.</blockquote><pre>a  b</pre><figure><figcaption>A boat</figcaption></figure>", "So be it.\na b\nA boat")])
@pytest.mark.parametrize("around", ["<article>%s</article>", "<body><nav><a href=/>Home</a></nav><main>%s</main><footer>Terms.</footer></body>"])
def test_lists_tables_and_links_of_the_article(model, around, inside, text):
    assert H.main_text(around % (ARTICLE + inside + "<p>At last the sun came out again.</p>"), model) == "\n".join(
        ["Storm", *GOOD, text, "At last the sun came out again."])


@pytest.mark.parametrize("before", [
    "<header><h1>Daily News</h1><p>All that happens, every day.</p></header>", "<header><h2>The Paper</h2>Since 1901. Your paper.</header>",
    '<header class="site"><a href="/">Daily News</a><p>Read by many. Loved by all.</p></header>',
    '<div id="masthead"><p>Daily News. Every day.</p></div>', "<div><header><p>Our paper. Your news.</p></header></div>"])
def test_headers_before_the_article(model, before):
    for tag in ("main", "article"):
        assert H.main_text(f"<body>{before}<{tag}>{ARTICLE}</{tag}></body>", model) == "\n".join(["Storm", *GOOD])


def test_a_header_of_the_article_stays(model):
    page = f"<body><main><article><header><h1>Storm</h1></header><p>{GOOD[0]}</p><p>{GOOD[1]}</p></article></main></body>"
    assert H.main_text(page, model) == "\n".join(["Storm", *GOOD])


@pytest.mark.parametrize("after", [
    '<section class="reader-opinions"><h3>Opinions</h3><p>I think that it was bad. Very bad.</p></section>',
    '<section id="comments"><p>What a night it was, I could not sleep. Stay safe.</p></section>',
    '<section><h2>What readers say</h2><p>They should have known. I told them so last year.</p><p>True!</p></section>',
    '<div class="responses"><p>I saw it from my window. What a storm it was.</p></div>'])
def test_reader_opinions(model, after):
    for tag in ("main", "article"):
        assert H.main_text(f"<body><{tag}>{ARTICLE}</{tag}>{after}</body>", model) == "\n".join(["Storm", *GOOD])
        assert H.main_text(f"<body><{tag}>{ARTICLE}{after}</{tag}></body>", model) == "\n".join(["Storm", *GOOD])


def test_pages_without_main_text(model):
    assert H.main_text("<nav><a href=/>Home</a><p>Long text. In a menu.</p></nav><footer>Imprint. All rights reserved.</footer>", model) == ""


def test_deep_and_long_pages_are_linear(model):
    assert H.main_text("<div>" * 20000 + "<p>Deep text. Yes.</p>", model) == "Deep text. Yes."
    long = "<article>" + "<p>Some words here. More of them.</p>" * 20000 + "</article>"
    assert H.main_text(long, model).count("\n") == 19999


def test_nulls_and_empty_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = H.extract(spark.createDataFrame([(1, None, None, "x", "y"), (None, "u", "", "x", "y"), (2, "u", "<p>Only. Text.", "x", "y")], schema))
    assert sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in rows.collect()) == [
        (0, "u", "", 0), (1, None, "", 0), (2, "u", "Only. Text.", 11)]
    assert H.extract(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("attributes", [
    'data-title="The hidden cost of rain"', 'title="a hidden gem"', 'class="post hidden md"', "title='hidden'", "data-x=hidden",
    'title="aria-hidden=true"', 'data-css="display:none"', 'data-hidden', 'aria-hidden="false"', 'title="x" data-y="\'hidden\'"',
    'style="--display:none"'])
def test_the_word_hidden_in_a_value_hides_nothing(model, attributes):
    assert H.main_text(f"<article {attributes}><p>Rain fell all night. Nobody slept.</p></article>", model) == (
        "Rain fell all night. Nobody slept.")


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN", 'hidden=""', 'class="a"hidden', 'aria-hidden="true"', "aria-hidden=true",
                                        "style='color:red; Display : none'", "title='x' hidden"])
def test_hidden_elements_stay_hidden(model, attributes):
    page = f"<main><p {attributes}>Secret words. No.</p><p>Open words. Yes.</p></main>"
    assert H.main_text(page, model) == "Open words. Yes."


RAIN = "<article><p>Rain fell all night. Nobody slept.</p><p>The road is closed. Boats help.</p></article>"
RAIN_TEXT = "Rain fell all night. Nobody slept.\nThe road is closed. Boats help."


@pytest.mark.parametrize("before", [
    "<datalist><option value=a><option value=b></datalist>", "<select><option>One<option>Two</select>", "<option>One", "<button>Menu",
    "<select><optgroup label=a><option>One<optgroup label=b><option>Two</select>", "<div><button>Menu</div>", "<div><svg><path d=M0></div>",
    "<object data=x>", "<video src=x>", "<audio>", "<canvas>", "<svg><path d=M0>", "<math><mi>", "<template>", "<select><option>One",
    "<button>A<button>B</button>", "<svg viewBox=x />", "<video><p>Get a browser. Please.</p></video>",
    "<template><p>Not shown. Never.</p><div><p>Nor this. Never.</p></div></template>"])
def test_page_goes_on_after_a_control(model, before):
    page = f"<html><body>{before}{RAIN}<select><option>Z</option></select></body></html>"
    assert H.main_text(page, model) == RAIN_TEXT


@pytest.mark.parametrize("control", ["<button>Play</button>", "<svg><title>i</title><path d=M0></svg>", "<video><p>Old. Browser.</p></video>",
                                     "<svg/>", "<select><option>One<option>Two</select>", "<math><mi>x</mi></math>"])
def test_a_control_does_not_split_the_text_around_it(model, control):
    assert H.main_text(f"<article><p>Rain fell {control} all night. Nobody slept.</p></article>", model) == "Rain fell all night. Nobody slept."
    link, = [n for n in H.parse(f"<p><a href=x>one {control} two</a></p>") if n.kind == H.TEXT]
    assert link.link_chars == sum(map(len, link.parts))


def test_raw_text_without_an_end_ends_the_page(model):
    assert H.main_text(RAIN + "<script>var x = '<p>More. Text.</p>'", model) == RAIN_TEXT
