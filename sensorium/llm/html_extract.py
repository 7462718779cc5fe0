"""Main text of web pages by inference in the page's tree.

A page is parsed into a tree of block elements whose leaves are runs of text.
Each node has a hidden state: inside the main text or not.  The joint
distribution is a tree-structured graphical model: a node's evidence and
potentials between a parent's state and its child's.  Sum-product messages go up
from the leaves and down from the root; the product of what reaches a node is
its exact marginal.  Text whose marginal of being inside exceeds one half, given
that a page has some main text, is the page's main text.

Evidence of an element is its tag and where it stands (inside a page's ``article``
or ``main``, outside of them, or on a page without), the words of its class, id
and role and of its heading, and the share of links in what it holds; of a text its
length, share of links and punctuation taken together, where it stands, and
whether it comes before the page's first ``h1``.  A state is passed down a chain
of elements at no cost but for changes, and elements with one child and no text
are one node with it, so depth alone says nothing.

Both tables are trained: by counting over labelled pages, with a prior of one
count in each cell.  The labelled pages are the templates below, whose
authors' marks say what is content, and at most ``max_labelled`` pages of the
corpus (the documented bound) that label themselves: what they have inside
``<article>`` or ``<main>``, less the menus, asides, forms and the like in it,
is content.  Markup that isn't text (scripts, styles, comments, attributes)
never becomes a node, and controls, drawings and media with what they hold
leave the tree.  One whose end tag is missing takes only its own text with it,
not the blocks that follow.

Inference is linear in a page's size and runs where the page is read; nothing
is shuffled.  The model is a few hundred numbers.

Defined results: null and empty html gives the empty text; broken markup is
read as browsers do (unclosed paragraphs end at the next block, unknown end
tags are ignored, a cut-off tag or raw text without an end ends the page); repeated rows get the same
text; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorium.llm.common import map_arrow, table

MAX_LABELLED = 400

# Kinds of HTML elements.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe xmp noembed noframes".split())
#: Ordinary elements in a page's tree, but never content.
CONTROLS = frozenset("template svg math object canvas audio video select optgroup option button".split())
P_CLOSERS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                      "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li "
                      "dd dt".split())
P_SCOPES = CONTROLS | {"td", "th", "caption", "table"}
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "option": {"option"},
               "optgroup": {"option", "optgroup"}, "button": {"button"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
          "th": {"table", "tr"}, "tbody": {"table"}, "option": {"select", "datalist", "optgroup"}, "optgroup": {"select", "datalist"},
          "button": {"object", "template"}}
CONTENT_TAGS = frozenset("article main".split())
NOISE_TAGS = frozenset("nav aside footer form dialog menu fieldset search".split())
# Words in class, id and role that name what isn't the article.
NOISE_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
                        "nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer foot copyright "
                        "sidebar side aside rail widget related recommended popular trending share sharing social follow "
                        "comment comments reply replies discussion disqus cookie cookies consent notice notices alert "
                        "gdpr popup modal overlay newsletter subscribe signup login search form pagination pager tags "
                        "skip toolbar legal disclaimer opinions reader readers response responses feedback thread remarks "
                        "guestbook talkback reviews".split())
#: Words of short headings over what isn't the article.
NOISE_HEADINGS = frozenset("comment comments reply replies discussion opinions readers responses feedback reviews related "
                           "recommended popular trending share newsletter subscribe sponsored advertisement menu".split())
CONTENT_WORDS = frozenset("article articlebody body content entry main post story text prose maintext".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)",
                    re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>]+)))?""")
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)", re.I)
_WORDS = re.compile("[a-z]+")
_SENTENCE = re.compile(r"[.!?。！？…]")

ELEMENT, TEXT = 0, 1
#: Log potential of what can't be: content in landmarks that are never the article.
NEVER = -40.0
#: A page whose texts are all this unlikely to be content has none.
NO_CONTENT = 1e-6
NEVER_TAGS = frozenset("nav aside footer dialog menu search form".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Of the tags of a chain of elements these say more than the innermost one.
SPEAKING = CONTENT_TAGS | NOISE_TAGS | HEADINGS | {"header", "section", "p", "li", "blockquote", "pre"}


class Node:
    __slots__ = ("parent", "kind", "tag", "tags", "names", "hidden", "mark", "parts", "link_chars", "features", "text", "closed")

    def __init__(self, parent: int, kind: int, tag: str, attributes: str = ""):
        self.parent, self.kind, self.tag = parent, kind, tag
        self.tags = {tag}  # of all elements that became this node
        self.names: set[str] = set()
        self.hidden, self.mark = False, None
        if attributes.strip():
            values: dict[str, str] = {}
            for m in _ATTRIBUTE.finditer(attributes):
                values.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")  # the first of a name counts
            for name in ("class", "id", "role"):
                self.names.update(_WORDS.findall(values.get(name, "").lower()))
            display = _DISPLAY.findall(values.get("style", ""))
            self.hidden = ("hidden" in values or values.get("aria-hidden", "").strip().lower() == "true"
                           or bool(display) and display[-1].lower() == "none")
            if values.get("data-content") in ("0", "1"):
                self.mark = values["data-content"] == "1"
        self.parts: list[str] = []
        self.link_chars = 0
        self.text = ""
        self.closed = False  # by its own end tag


def parse(html: str) -> list[Node]:
    """The page's nodes in page order; a node's parent comes before it."""
    nodes = [Node(-1, ELEMENT, "#root")]
    stack = [0]  # open elements, block and inline; inline ones are (tag,) entries
    inline: list[str] = []
    run: Node | None = None  # the run of text that is being read
    around: dict[int, tuple[Node | None, list[str]]] = {}  # the run and inline elements that a control stands in
    at, size = 0, len(html)

    def add_text(raw: str) -> None:
        nonlocal run
        if run is None:
            if not raw.strip():
                return
            run = Node(stack[-1], TEXT, nodes[stack[-1]].tag)
            nodes.append(run)
        text = html_lib.unescape(raw)
        run.parts.append(text)
        if "a" in inline:
            run.link_chars += len(text)

    def close_to(depth: int) -> None:
        nonlocal run
        if len(stack) > depth:
            del stack[depth:]
            inline.clear()
        run = None

    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            add_text(html[at:])
            break
        if lt > at:
            add_text(html[at:lt])
        m = _TOKEN.match(html, lt)
        if m is None:  # a lone <
            add_text("<")
            at = lt + 1
            continue
        at = m.end()
        if m[2] is None:
            continue  # a comment or declaration
        tag = m[2].lower()
        if not m[4]:
            break  # the page is cut off inside a tag
        if m[1]:
            if tag in INLINE:
                if tag in inline:
                    inline.reverse()
                    inline.remove(tag)
                    inline.reverse()
            elif tag == "br":
                add_text(" ")
            else:
                for depth in range(len(stack) - 1, 0, -1):
                    if nodes[stack[depth]].tag == tag:
                        control = stack[depth]
                        nodes[control].closed = True
                        close_to(depth)
                        if tag in CONTROLS:
                            run, inline[:] = around[control]
                            if run is not None:
                                add_text(" ")
                        break
                else:
                    if tag in P_CLOSERS:
                        run = None
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
                if end is None:
                    break
                close = html.find(">", end.end())
                at = size if close < 0 else close + 1
            if run is not None:
                add_text(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                run = None
            elif run is not None:
                add_text(" ")
            continue
        if tag in INLINE:
            if not m[3].endswith("/"):
                inline.append(tag)
            continue
        if tag in P_CLOSERS:
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = nodes[stack[depth]].tag
                if open_tag == "p":
                    close_to(depth)
                    break
                if open_tag in P_SCOPES:
                    break
        if tag in SAME_CLOSES:
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = nodes[stack[depth]].tag
                if open_tag in SCOPES[tag]:
                    break
                if open_tag in SAME_CLOSES[tag]:
                    close_to(depth)
                    break
        if tag in CONTROLS:
            if m[3].endswith("/"):
                if run is not None:
                    add_text(" ")
                continue
            around[len(nodes)] = run, inline.copy()
            inline.clear()
        run = None
        nodes.append(Node(stack[-1], ELEMENT, tag, m[3]))
        if not m[3].endswith("/"):
            stack.append(len(nodes) - 1)
    nodes = _without_controls(nodes) if around else nodes
    for node in nodes:
        if node.kind == TEXT:
            node.text = " ".join("".join(node.parts).split())
    return _without_chains(nodes)


def _without_chains(nodes: list[Node]) -> list[Node]:
    """The tree with each element that holds one element and nothing else joined to it."""
    children = [0] * len(nodes)
    only = [-1] * len(nodes)
    for i in range(1, len(nodes)):
        children[nodes[i].parent] += 1
        only[nodes[i].parent] = i
    kept: list[Node] = []
    place = [0] * len(nodes)
    above: dict[int, list[Node]] = {}  # the chain that ends in a node
    for i, node in enumerate(nodes):
        chain = above.pop(i, [])
        if i and node.kind == ELEMENT and children[i] == 1 and nodes[only[i]].kind == ELEMENT:
            above[only[i]] = [*chain, node] if len(chain) < 2 else [_joined(chain[0], chain[1]), node]
            place[i] = place[node.parent]  # where the chain hangs
            continue
        for x in chain:
            _joined(node, x)
        if i:
            node.parent = place[node.parent]
        place[i] = len(kept)
        kept.append(node)
    return kept


def _joined(node: Node, outer: Node) -> Node:
    """The node with what an element around it says; a mark of its own stays."""
    node.tags |= outer.tags
    node.names |= outer.names
    node.hidden |= outer.hidden
    if node.mark is None:
        node.mark = outer.mark
    return node


def _without_controls(nodes: list[Node]) -> list[Node]:
    """The tree less its controls and what they hold.  Blocks in a control that has
    no end tag belong to the page around it."""
    kept: list[Node] = []
    place = [-1] * len(nodes)  # in ``kept``: of the node, or of what holds its children; -1: they go, too
    for i, node in enumerate(nodes):
        if i:
            above = nodes[node.parent]
            holder = place[node.parent]
            if holder < 0 or above.tag in CONTROLS and node.kind == TEXT:
                continue
            if node.tag in CONTROLS and node.kind == ELEMENT:
                place[i] = -1 if node.closed else holder
                continue
            node.parent = holder
        place[i] = len(kept)
        kept.append(node)
    return kept


def _bin(x: float, edges: tuple) -> int:
    return sum(x >= e for e in edges)


def evidence(nodes: list[Node]) -> None:
    """Set each node's features: (name, value) pairs that the model has tables for."""
    n = len(nodes)
    chars, links = [0] * n, [0] * n
    first_h1, heading = n, [None] * n
    for i, node in enumerate(nodes):
        if node.kind == TEXT:
            chars[i], links[i] = sum(map(len, node.parts)), node.link_chars
        elif "h1" in node.tags:
            first_h1 = min(first_h1, i)
    for i in range(n - 1, 0, -1):
        above = nodes[i].parent
        chars[above] += chars[i]
        links[above] += links[i]
    kin: dict[tuple, list[tuple[int, int]]] = {}  # the two longest children of each tag that a node has
    for i, node in enumerate(nodes):
        if i and node.kind == ELEMENT:
            longest = kin.setdefault((node.parent, node.tag), [])
            longest.append((chars[i], i))
            longest.sort(reverse=True)
            del longest[2:]
        # A short heading speaks for the element that it opens.
        if node.kind == TEXT and node.tag in HEADINGS and node.text.count(" ") < 6:
            holder = nodes[node.parent].parent
            if holder > 0 and heading[holder] is None:
                heading[holder] = bool(set(_WORDS.findall(node.text.lower())) & NOISE_HEADINGS)
    landmarks = any(node.kind == ELEMENT and node.tags & CONTENT_TAGS for node in nodes)
    where = ["out" if landmarks else "none"] * n
    for i, node in enumerate(nodes):
        above = where[node.parent] if i else where[i]
        share = _bin(links[i] / max(chars[i], 1), (0.01, 0.3, 0.8))
        if node.kind == TEXT:
            where[i] = above
            count = node.text.count(" ") + 1 if node.text else 0
            node.features = (("text", (_bin(count, (1, 4, 10, 25)), share, bool(_SENTENCE.search(node.text)))),
                             ("h1", (where[i], "none" if first_h1 == n else "before" if i < first_h1 else "after")))
            continue
        noise, good = bool(node.names & NOISE_WORDS), bool(node.names & CONTENT_WORDS)
        # What is named as something else, and doesn't hold most of the page, stands aside with all that it holds.
        aside = (noise and not good or heading[i] or node.tags & NOISE_TAGS) and 2 * chars[i] <= chars[0]
        where[i] = "aside" if aside or above == "aside" else "in" if node.tags & CONTENT_TAGS else above
        longest = next((c for c, j in kin.get((node.parent, node.tag), ()) if j != i), 0)
        node.features = (*((("tag", (t, where[i])) for t in sorted(node.tags & SPEAKING) or [node.tag]) if i else ()),
                         ("names", (noise, good)), ("hidden", node.hidden), ("heading", heading[i] is True),
                         ("share", (share, _bin(chars[i], (20, 200)))), ("kin", _bin(longest, (1, 60, 200))))


def labels(nodes: list[Node], marked: bool) -> list[bool]:
    """States of a labelled page's nodes.  ``marked``: its authors marked them;
    else its landmark elements tell."""
    inside = [False] * len(nodes)
    for i, node in enumerate(nodes):
        above = inside[node.parent] if i else False
        if marked:
            inside[i] = above if node.mark is None else node.mark
        elif node.kind == ELEMENT and (node.tags & NOISE_TAGS or node.hidden or node.names & NOISE_WORDS):
            inside[i] = False
        else:
            inside[i] = above or (node.kind == ELEMENT and bool(node.tags & CONTENT_TAGS))
    return inside


class Model:
    """Log potentials.  ``emit[feature][value]`` and ``link[parent state]`` hold a
    value for each state of the node."""

    def __init__(self):
        self.counts: dict = defaultdict(lambda: [1.0, 1.0])
        self.links = [[1.0, 1.0], [1.0, 1.0]]

    def learn(self, nodes: list[Node], state: list[bool], weight: float = 1.0) -> None:
        evidence(nodes)
        for node, s in zip(nodes, state, strict=True):
            if node.parent < 0:
                continue  # the root is no one's child, and like any page's
            for feature in node.features:
                self.counts[feature][s] += weight
            self.links[state[node.parent]][s] += weight

    def finish(self) -> Model:
        totals: dict = defaultdict(lambda: [0.0, 0.0])
        for (name, _), c in self.counts.items():
            totals[name][0] += c[0]
            totals[name][1] += c[1]
        self.emit = {(name, value): tuple(math.log(c[s] / totals[name][s]) for s in (0, 1))
                     for (name, value), c in self.counts.items()}
        self.link = tuple(tuple(math.log(x / sum(row)) for x in row) for row in self.links)
        del self.counts, self.links
        return self

    def unary(self, nodes: list[Node]) -> list[list[float]]:
        """The evidence of each node for each state."""
        evidence(nodes)
        never, out = _never(nodes), []
        for i, node in enumerate(nodes):
            a, b = 0.0, NEVER if i in never else 0.0
            for feature in node.features if i else ():
                x = self.emit.get(feature)
                if x:
                    a += x[0]
                    b += x[1]
            out.append([a, b])
        return out

    def _up(self, nodes: list[Node], scores: list[list[float]]) -> list[tuple]:
        """Messages from the leaves to the root: a node's is its subtree's evidence, for each state of
        its parent.  ``scores`` gains them."""
        link, message = self.link, [None] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            a, b = scores[i]
            up = message[i] = tuple(_add(link[s][0] + a, link[s][1] + b) for s in (0, 1))
            above = scores[nodes[i].parent]
            above[0] += up[0]
            above[1] += up[1]
        return message

    def marginals(self, nodes: list[Node], scores: list[list[float]] | None = None) -> list[float]:
        """Probability of content for each node, by one pass of messages up and one down.
        ``scores``: the nodes' evidence, if it is known; it gains the messages."""
        link, scores = self.link, self.unary(nodes) if scores is None else scores
        message = self._up(nodes, scores)
        belief = [tuple(scores[0])] + [(0.0, 0.0)] * (len(nodes) - 1)
        for i in range(1, len(nodes)):  # down: what the parent believes without this child's own message
            parent = belief[nodes[i].parent]
            outside = (parent[0] - message[i][0], parent[1] - message[i][1])
            belief[i] = tuple(scores[i][s] + _add(outside[0] + link[0][s], outside[1] + link[1][s]) for s in (0, 1))
        return [1 / (1 + math.exp(min(max(a - b, -700.0), 700.0))) for a, b in belief]

    def beliefs(self, nodes: list[Node]) -> tuple[list[float], float]:
        """The marginals, and the probability that any text is content: less the weight of all
        states in which none is."""
        scores = self.unary(nodes)
        none = [[a, -1e9 if n.kind == TEXT and n.text else b] for (a, b), n in zip(scores, nodes, strict=True)]
        self._up(nodes, none)
        content = self.marginals(nodes, scores)
        return content, -math.expm1(min(_add(*none[0]) - _add(*scores[0]), 0.0))


def _never(nodes: list[Node]) -> set[int]:
    """Nodes that can't be content: hidden ones and the landmarks, but for a form
    around most of the page's text (some sites put one around the whole page)."""
    found = {i for i, x in enumerate(nodes) if x.hidden or x.kind == ELEMENT and x.tags & NEVER_TAGS}
    if any("form" in nodes[i].tags for i in found):
        held = [len(x.text) for x in nodes]
        for i in range(len(nodes) - 1, 0, -1):
            held[nodes[i].parent] += held[i]
        found -= {i for i in found if nodes[i].tags & NEVER_TAGS == {"form"} and not nodes[i].hidden and 2 * held[i] > held[0]}
    for i, x in enumerate(nodes):  # and all that they hold
        if i and x.parent in found:
            found.add(i)
    return found


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a))


# Labelled pages: common page layouts; data-content says where the main text is (1) and isn't (0).
_SENTENCES = ("The river rose again after two days of rain, and the lower road was closed.",
              "Officials said that repairs would take a week, if the weather holds.", "A short day.",
              "Nobody was hurt; a bridge near the old mill will be inspected on Monday, they added.")
_BODY = ("".join(f"<p>{s} {t}</p>" for s in _SENTENCES for t in ("", _SENTENCES[0]))
         + "<h2>What comes next</h2><ul>" + "".join(f"<li>{x}</li>" for x in (
             "Repairs of the road", "A meeting with the town", "Boats", *_SENTENCES)) + "</ul>"
         + "<blockquote><p>We waited all night.</p></blockquote><pre>level 3.2 m</pre>"
         + "<table><tr><td>Monday</td><td>3.2</td></tr></table>")
_LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport", "Weather", "About us"))
#: Links, lists of links and short items that are the article's own.
_LINKED = ('<ul><li><a href="/map">Map of the roads</a></li><li>Boots</li><li>Buy three pumps</li><li><a href="/l">Levels, hour by hour</a></li></ul>'
           '<p><a href="/report">Read the full report of the office.</a></p><ol><li><a href="/1">One</a></li><li>two</li></ol>'
           '<table><tr><th>Day</th><th>Level</th></tr><tr><td>Tuesday</td><td><a href="/t">3.4</a></td></tr></table>')
_TEMPLATES = [
    '<body data-content=0><header><h2>Daily News</h2><nav><ul>{links}</ul></nav></header><main><article data-content=1><h1>River rises</h1>{body}'
    '</article></main><aside class="sidebar"><h3>Related</h3><ul>{links}</ul><p>Most read this week, by our readers.</p></aside>'
    '<footer><p>&copy; Daily News. All rights reserved.</p></footer></body>',
    '<body data-content=0><div id="header"><a href="/">Daily News</a></div><div class="menu"><ul>{links}</ul></div><div class="content" data-content=1>'
    '<h1>River rises</h1>{body}</div><div class="ad">Buy two pumps, pay for one! Offer ends soon.</div><div id="footer">Imprint. Contact us.</div></body>',
    '<body data-content=0><div class="cookie-notice"><p>We use cookies. By reading on you accept them.</p></div><nav><a href="/a">Home</a> <a href="/b">News</a>'
    '</nav><div class="post"><div class="entry" data-content=1><h1>River rises</h1>{body}</div><div class="share"><a href="/s">Share this</a></div>'
    '<div class="comments"><h3>2 comments</h3><div class="comment"><p>I saw it too, it was terrible. Stay safe, everyone.</p></div>'
    '<div class="comment"><p>Thank you for reporting this so quickly.</p></div></div></div><footer>&copy; 2020</footer></body>',
    '<body data-content=0><table><tr><td class="nav"><ul>{links}</ul></td></tr></table><section data-content=1><h1>River rises</h1>{body}</section>'
    '<form class="newsletter"><p>Get our letter every morning. It is free.</p><label>Your address</label></form></body>',
    '<body data-content=0><article data-content=1><header><h1>River rises</h1></header>{body}<div class="ad" data-content=0>Sale! New boats. Call us today.</div>'
    '<aside class="related" data-content=0><p>See also: the flood of last year.</p></aside></article><section id="comments"><article><p>First! What a river.'
    '</p></article></section><footer><ul>{links}</ul></footer></body>',
    '<body data-content=0><div class="page"><div data-content=1><h1>River rises</h1>{body}</div><form><p>What do you think? Write to us.</p><p>Your name.</p></form>'
    '<div><form><fieldset><p>Find more. Search all our reports.</p></fieldset></form></div></div></body>',
    '<body data-content=0><div class="banner">Special offer: read four weeks for free.</div><div><ul>{links}</ul></div><div><div data-content=1><h1>River rises</h1>'
    '{body}</div></div><div class="footer"><p>About this site. Terms of use.</p></div></body>',
    '<body data-content=0><header><h1>Daily News</h1><p>All that happens here, every day.</p></header><main data-content=1><h1>River rises</h1>{body}'
    '{linked}</main><section class="readers"><h3>What readers say</h3><p>I saw it from my window. What a night.</p><p>Stay safe!</p></section></body>',
    '<body data-content=0><header><p>Your paper since 1901. Printed and online.</p><ul>{links}</ul></header><article data-content=1>{body}{linked}</article>'
    '<section><h2>Readers&#39; opinions</h2><p>They should have built a dam. I said so years ago.</p></section><footer><p>Terms.</p></footer></body>',
    '<body data-content=0><div><div><ul>{links}</ul></div><p>You are here: News.</p></div><div><div><div data-content=1><h2>River rises</h2>{body}{linked}'
    '</div></div></div><div><ul>{links}</ul></div></body>',
    '<body data-content=1><h1>River rises</h1>{body}{linked}</body>',
    '<body data-content=0><div><ul>{links}</ul></div><main data-content=1><p>{first}</p><p>{first}</p></main><div><p>Imprint. All rights reserved.</p></div></body>',
    '<body data-content=0><div><div><div data-content=1><p>{first}</p><p>A short day.</p></div></div></div></body>',
]


def template_page(template: str) -> str:
    return "<html>" + template.format(links=_LINKS, body=_BODY, linked=_LINKED, first=_SENTENCES[0]) + "</html>"


def train(labelled: list[str]) -> Model:
    """The templates together weigh as much as ``MAX_LABELLED`` pages of the corpus,
    so that a corpus of one layout doesn't hide what other layouts show."""
    model = Model()
    for template in _TEMPLATES:
        nodes = parse(template_page(template))
        model.learn(nodes, labels(nodes, marked=True), weight=MAX_LABELLED / len(_TEMPLATES))
    for page in labelled:
        nodes = parse(page)
        model.learn(nodes, labels(nodes, marked=False))
    return model.finish()


def main_text(page: str, model: Model) -> str:
    nodes = parse(page)
    content, some = model.beliefs(nodes)
    if some < NO_CONTENT:
        return ""
    return "\n".join(n.text for n, p in zip(nodes, content, strict=True) if n.kind == TEXT and n.text and p > 0.5 * some)


def _extract(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, model) if x else "" for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    return run


def labelled_pages(pages: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """At most ``max_labelled`` pages that label themselves, chosen by hash.  A
    threshold on the hash leaves about four times as many to choose from, so
    what goes to the driver doesn't grow with the number of partitions."""
    own = pages.select("html", F.xxhash64("html").alias("hash")).where(F.col("html").rlike("(?i)<(article|main)[ >]"))
    share = min(1.0, 4 * max_labelled / max(own.count(), 1))
    few = own.where(F.col("hash") <= min(int((2 * share - 1) * 2**63), 2**63 - 1))
    return few.orderBy("hash", "html").limit(max_labelled).select("html")


def extract(pages: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` per row of ``pages``."""
    model = train([r[0] for r in labelled_pages(pages, max_labelled).collect()])
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_arrow(rows, _extract(model), "page_id long, url string, text string, n_chars long")


def op3_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
