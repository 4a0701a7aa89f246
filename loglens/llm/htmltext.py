"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into flat blocks at block-level tags.  A block's features are its
words and link density, those of the blocks before and after it, whether it is
a heading, and facts about the elements around it: inside article-like
elements, and the part of the page's words without links that lies outside the
boilerplate elements around the block: near 0 for a wrapper of the whole page,
near 1 for a small box.  That part is taken twice: for elements that are
boilerplate by tag, role or a plain name (``sidenav``, ``cookieBanner``), and
for those whose name only hints at it (``legal``, ``form-field``,
``has-sidebar``), which in an article mostly hold its text.  A decision tree
(Gini, grown on the driver from the blocks of the small labelled pages below)
says which blocks are main text.

Reader comments are found by name, as an article within an article, or below a
heading that says just "Comments" (four languages), up to the next heading of
its rank or the end of the element that holds it.

Inside a block character references are decoded, white space becomes one
space, and ends are trimmed; kept blocks are joined by one newline.  Nothing
else is dropped: comments, scripts, styles and form controls hold no text.

Defined results: a null, empty or blank page has the text ''; malformed markup
(unclosed elements, cut tags, a lone ``<``, unmatched quotes) is read as far as
it goes, in time linear in the page; repeated rows give repeated results.
"""
from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import map_arrow, pick, table

SPACE = re.compile(r"[\x20\x09-\x0D]+")
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul
    caption head""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose content is no text of the page.
SKIPPED = frozenset("script style noscript template textarea title iframe svg select button object canvas audio video noembed noframes xmp datalist".split())
#: Elements that are followed on the stack of open elements.
HELD = frozenset("article aside blockquote details dialog div fieldset figure footer form header main menu nav ol search section table td ul li dl".split())
#: Of those, the ones a new sibling closes.
SELF_CLOSING = frozenset(["li", "td"])
BAD_TAGS = frozenset("aside dialog fieldset footer form menu nav search".split())
#: Of those, the ones that never wrap the main text.
HARD_TAGS = frozenset("aside dialog footer menu nav search".split())
GOOD_TAGS = frozenset("article main".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
#: Words of names that are boilerplate wherever they stand.
BAD_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright
    disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo related replies reply
    respond share sharing sidebar signup social sponsor sponsored subscribe toolbar""".split())
#: Words of names that as often belong to the text.
WEAK_WORDS = frozenset("disclaimer discussion form header legal login widget".split())
#: Of the first, those of reader comments: they never wrap the main text.
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond".split())
GOOD_WORDS = frozenset("article content entry main post story".split())
#: First words that make a name tell of something else: 'has-sidebar', 'category-ads'.
SOFT_STARTS = frozenset("category has hide no tag type with without".split())
#: Words that are joined with the others to one: 'sidenav', 'relatedposts'.
JOINED_WORDS = frozenset("""area articles bar block body bottom box btn button buttons column container global inner item left links list login outer page panel
    posts right section side site stories text title top wrap wrapper""".split())
KNOWN_WORDS = BAD_WORDS | WEAK_WORDS | GOOD_WORDS | JOINED_WORDS
LONGEST = max(map(len, KNOWN_WORDS))
#: Words of a name: runs of small letters, an upper case letter begins one.
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Headings of reader comments.
COMMENT_HEADING = re.compile(
    r"\(?\d*\)? ?(?:reader |user )?(?:comments|replies|responses|kommentare|leserkommentare|commentaires|comentarios|leave a (?:comment|reply))"
    r" ?:? ?\(?\d*\)?", re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "heading", "inside", "boilerplate", "hinted")
#: How an element is boilerplate.
PLAIN, HINTED, STRONG, HARD = range(4)


class Block:
    __slots__ = ("text", "words", "linked", "heading", "inside", "bad", "hinted")

    def __init__(self, text, words, linked, heading, inside, bad):
        self.text, self.words, self.linked, self.heading, self.inside, self.bad, self.hinted = text, words, linked, heading, inside, bad, 0.0


def split_joined(word: str) -> list[str]:
    """The known words that make up ``word``, or the word itself if it isn't
    such a chain or is known; the fewest words win."""
    if word in KNOWN_WORDS:
        return [word]
    best: list[tuple[int, int] | None] = [(0, 0)] + [None] * len(word)      # (number of words, start of the last)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - LONGEST), end):
            if best[start] and word[start:end] in KNOWN_WORDS and (best[end] is None or best[start][0] + 1 < best[end][0]):
                best[end] = best[start][0] + 1, start
    if not best[-1]:
        return [word]
    out, end = [], len(word)
    while end:
        start = best[end][1]
        out.append(word[start:end])
        end = start
    return out[::-1]


@lru_cache(maxsize=4096)
def name_kind(name: str) -> tuple[bool, int, bool]:
    """(article-like, how it is boilerplate, header only) of one class or id."""
    words = [w for part in NAME.findall(name) for w in split_joined(part.lower())]
    found = set(words)
    soft = bool(words) and words[0] in SOFT_STARTS
    if found & BAD_WORDS:
        how = HINTED if soft else HARD if found & COMMENT_WORDS else STRONG
    else:
        how = HINTED if found & WEAK_WORDS else PLAIN
    return bool(found & GOOD_WORDS) and not soft, how, how == HINTED and found & WEAK_WORDS == {"header"} and not soft


def kind_of(tag: str, attributes: str, inside: bool, in_article: bool = False) -> tuple[bool, int]:
    """(article-like, how it is boilerplate) of an element by its tag and
    names.  Names of an article or main element hint at most; the header of an
    article belongs to it; an article in an article is a comment or a teaser."""
    good = False
    bad = HARD if tag in HARD_TAGS else STRONG if tag in BAD_TAGS or tag == "header" and not inside or tag == "article" and in_article else PLAIN
    if "=" in attributes:
        named = PLAIN
        for m in ATTRIBUTE.finditer(attributes):
            value = m[2] or m[3] or m[4] or ""
            if m[1].lower() == "role":
                words = set(value.lower().split())
                good, bad = good or bool(words & {"main", "article"}), max(bad, STRONG if words & BAD_ROLES else PLAIN)
                continue
            kinds = [name_kind(name) for name in value.split()]
            own = any(k[0] for k in kinds)
            good = good or own
            named = max([named, *(k[1] for k in kinds if not (k[2] and (inside or own)))])
        bad = max(bad, min(named, HINTED) if tag in GOOD_TAGS else named)
    return tag in GOOD_TAGS and bad < STRONG or good and not bad, bad


def outside_parts(out: list[Block], parents: list[int], kinds: list[int]) -> None:
    """Turn ``bad`` of the blocks, the number of their narrowest boilerplate
    element or -1, into the part of the page's words outside of such elements
    (``hinted`` for those only hinted at); 1 if most of the text of articles
    lies outside, or the element never wraps any."""
    plain = [b.words - b.linked for b in out]
    total, article = sum(plain), sum(n for n, b in zip(plain, out) if b.inside)
    words, inner = [0] * len(parents), [0] * len(parents)
    for n, b in zip(plain, out):
        if b.bad >= 0:
            words[b.bad] += n
            inner[b.bad] += n * b.inside
    for e in range(len(parents) - 1, -1, -1):       # parents come before
        if parents[e] >= 0:
            words[parents[e]] += words[e]
            inner[parents[e]] += inner[e]
    parts = []                                      # (of plain boilerplate, of what is hinted at)
    for e, up in enumerate(parents):
        own = 1.0 if kinds[e] == HARD or not total or 2 * inner[e] < article else 1 - words[e] / total
        own = max(own, 0.001)                       # a box that holds everything is still marked
        strong, hinted = parts[up] if up >= 0 else (0.0, 0.0)
        parts.append((strong, max(own, hinted)) if kinds[e] == HINTED else (max(own, strong), hinted))
    for b in out:
        b.bad, b.hinted = parts[b.bad] if b.bad >= 0 else (0.0, 0.0)


def tag_end(page: str, start: int, no_quote_from: list[int]) -> int:
    """Index after the tag that starts at ``start``: the first '>' outside
    quotes; the first '>' at all if a quote never closes; the end if none."""
    end = page.find(">", start)
    if end < 0:
        return len(page)
    first, at = end, start
    while True:
        quote = next((c for c in page[at:end] if c in "\"'"), None)
        if quote is None:
            return end + 1
        opened = page.find(quote, at, end)
        if page[at:opened].rstrip()[-1:] != "=":           # a quote that opens no value
            at = opened + 1
            continue
        closed = page.find(quote, opened + 1) if opened < no_quote_from["\"'".index(quote)] else -1
        if closed < 0:
            no_quote_from["\"'".index(quote)] = min(no_quote_from["\"'".index(quote)], opened)
            return first + 1
        at = closed + 1
        if at > end:
            end = page.find(">", at)
            if end < 0:
                return first + 1


def blocks(page: str | None) -> list[Block]:
    """The flat text blocks of a page, in order."""
    out: list[Block] = []
    if not page:
        return out
    held: list[tuple[str, bool, int]] = []      # open elements: tag, inside an article, narrowest boilerplate element
    parents: list[int] = []                     # of boilerplate elements: the next one around
    kinds: list[int] = []
    comments: list[tuple[int, int, int, int]] = []   # heading of comments: rank, open elements at it, its number as an element, blocks with it
    open_tags: dict[str, int] = {}              # number of open elements by tag
    rank = 0                                    # of the heading at hand
    parts: list[str] = []
    linked_parts: list[str] = []
    heading, own_bad = False, -1
    in_link = 0
    no_quote_from = [len(page), len(page)]
    closers: dict[str, int] = {}                # elements that don't close after this place

    def flush():
        nonlocal heading, own_bad
        if parts:
            text = SPACE.sub(" ", "".join(parts)).strip(" ")
            if text:
                n = text.count(" ") + 1
                linked = min(n, len(SPACE.sub(" ", " ".join(linked_parts)).split()))
                top = held[-1] if held else ("", False, -1)
                if heading and comments and rank <= comments[-1][0]:
                    comments.pop()
                if heading and not comments and COMMENT_HEADING.fullmatch(text):
                    comments.append((rank, len(held), marked(HARD, top[2]), len(out) + 1))
                bad = own_bad if own_bad >= 0 else top[2]
                out.append(Block(text, n, linked, heading, top[1], comments[-1][2] if comments else bad))
        parts.clear()
        linked_parts.clear()
        heading, own_bad = False, -1

    def marked(kind: int, around: int) -> int:
        parents.append(around)
        kinds.append(kind)
        return len(parents) - 1

    def text(s: str):
        if s:
            s = unescape(s) if "&" in s else s
            parts.append(s)
            if in_link:
                linked_parts.append(s)

    at = 0
    while at < len(page):
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        nxt = page[lt + 1:lt + 2]
        if nxt == "!" or nxt == "?":
            text(page[at:lt])
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
                at = len(page) if end < 0 else end + 3
            else:
                end = page.find(">", lt)
                at = len(page) if end < 0 else end + 1
            continue
        closing = nxt == "/"
        m = TAG_NAME.match(page, lt + 1 + closing)
        if not m:
            if closing:                          # '</' and no name: a bogus comment
                text(page[at:lt])
                end = page.find(">", lt)
                at = len(page) if end < 0 else end + 1
            else:                                # a lone '<' is text
                text(page[at:lt + 1])
                at = lt + 1
            continue
        text(page[at:lt])
        at = tag_end(page, m.end(), no_quote_from)
        tag = m[0].lower()
        if tag in SKIPPED:
            if not closing and page[at - 2:at] != "/>":
                if closers.get(tag, len(page)) > at:
                    end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                    if end:
                        gt = page.find(">", end.end())
                        at = len(page) if gt < 0 else gt + 1
                    else:
                        closers[tag] = at
                        if tag in ("script", "style", "textarea", "title"):
                            at = len(page)
            continue
        if tag == "br":
            text(" ")
        elif tag == "a":
            in_link = 0 if closing else 1
        elif tag in BLOCKS:
            flush()
            in_link = 0
            inside, bad = held[-1][1:] if held else (False, -1)
            if closing:
                if tag in HELD and open_tags.get(tag):
                    while True:
                        gone = held.pop()[0]
                        open_tags[gone] -= 1
                        if gone == tag:
                            break
                    if comments and len(held) < comments[-1][1]:
                        was, _, number, seen = comments.pop()
                        if len(out) == seen:         # the element held just the heading
                            comments.append((was, len(held), number, seen))
                continue
            if tag in SELF_CLOSING and held and held[-1][0] == tag:
                held.pop()
                open_tags[tag] -= 1
                inside, bad = held[-1][1:] if held else (False, -1)
            good, own = kind_of(tag, page[m.end():at - 1], inside, bool(open_tags.get("article")))
            if tag in HELD:
                open_tags[tag] = open_tags.get(tag, 0) + 1
                held.append((tag, inside or good, marked(own, bad) if own else bad))
            else:
                own_bad = marked(own, bad) if own and tag not in ("body", "html") else -1
                heading = tag in HEADINGS
                rank = int(tag[1]) if heading else 0
    flush()
    outside_parts(out, parents, kinds)
    return out


def features(page: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block."""
    n = len(page)
    words = np.array([b.words for b in page], float)
    links = np.array([b.linked / b.words for b in page], float)
    x = np.zeros((n, len(FEATURES)))
    x[:, 0], x[:, 1] = words, links
    x[1:, 2], x[1:, 3] = words[:-1], links[:-1]
    x[:-1, 4], x[:-1, 5] = words[1:], links[1:]
    x[:, 6] = [b.heading for b in page]
    x[:, 7] = [b.inside for b in page]
    x[:, 8] = [b.bad for b in page]
    x[:, 9] = [b.hinted for b in page]
    return x


# ------------------------------------------------------------- labelled table

def _words(n: int) -> str:
    return " ".join(["word"] * n) + "."


#: Paragraph lengths of the labelled pages.
SIZES = ((45, 80, 3, 30, 1, 120), (1, 1, 2, 1), (40, 1, 40, 2, 1), (1, 25, 4, 1, 60), (150, 2, 300), (7, 1, 7, 1, 7, 1), (90, 200, 14), (500,))


def labelled_pages() -> list[tuple[str, list[int]]]:
    """Small labelled pages: (html, label of each block; 1: main text).  Each
    layout comes with several lengths of paragraphs, so that a tree can tell
    the layout's facts from chance ones about lengths."""
    link = "<a href='/x'>{}</a>".format
    menu = "<ul>" + "".join(f"<li>{link(w)}</li>" for w in ("Home", "News", "About us")) + "</ul>"
    foot = "&copy; 2020 Example. All rights reserved."
    out = []
    for i, sizes in enumerate(SIZES):
        text, art = "".join(f"<p>{_words(n)}</p>" for n in sizes), [1] * len(sizes)
        other = SIZES[i - 1][0]                  # length of a block beside the article
        note = f"<p>{_words(other)}</p>"
        comment = f"<div class='comment'>{note}</div>"
        out += [
            (f"<nav>{menu}</nav><article><h1>Some title</h1>{text}</article><footer>{foot}</footer>", [0, 0, 0, 1, *art, 0]),
            (f"<header><div>{link('Logo')}</div>{menu}</header><main><h1>Some title</h1>{text}</main><aside>{note}</aside>", [0, 0, 0, 0, 1, *art, 0]),
            (f"<div class='menu'>{menu}</div><div class='ad'>{_words(other)}</div><article>{text}<div class='share'>{link('Share this')}</div>"
             f"<div class='newsletter'>{note}</div></article>{comment}", [0, 0, 0, 0, *art, 0, 0, 0]),
            (f"<div id='cookie-notice'>{note}</div><div id='content'><h2>Some title here</h2>{text}</div><form><p>Your name</p></form>", [0, 1, *art, 0]),
            (f"<article>{text}</article><section class='comments'>{comment}{comment}</section><p>Terms</p><p>Imprint</p>", [*art, 0, 0, 0, 0]),
            (f"<article><h1>Title</h1><p>{link('A paragraph that is one link')}</p>{text}</article><div>{link('Contact')} {link('Imprint')}</div>", [1, 1, *art, 0]),
            (f"<aside>{note}{note}</aside><article>{text}</article><footer>{note}</footer>", [0, 0, *art, 0]),
            # no article element: only lengths and links tell
            (f"{menu}<h1>A title of six words here</h1><p>{_words(45)}</p><p>{_words(80)}</p><p>{_words(20 + other)}</p><p>{link('Next page')} {link('Previous page')}</p>",
             [0, 0, 0, 1, 1, 1, 1, 0]),
            (f"<div>{link('One')} {link('Two')} {link('Three')}</div><div>{_words(60)}</div><div>{_words(18)}</div><div>{_words(70 + other)}</div><div>{link('Contact')} {link('Imprint')}</div>",
             [0, 1, 1, 1, 0]),
            (f"<div>Login</div><div>Search</div><div>{_words(90)}</div><div>{_words(40 + other)}</div><div>Terms</div><div>Privacy</div>", [0, 0, 1, 1, 0, 0]),
            (f"<ul>{''.join(f'<li>{link(_words(n + 5))}</li>' for n in sizes)}</ul><p>{_words(30)}</p><p>{_words(50 + other)}</p>", [0 * n for n in sizes] + [1, 1]),
            (f"<p>{_words(15 + other)}</p>", [1]),
        ]
        # names of boilerplate on what holds the article; lists of links belong to it
        links = f"<ul>{''.join(f'<li>{link(_words(n + 3))}</li>' for n in (1, 4, 2, 6))}</ul>"
        flagged = f"<h1>Some title</h1>{text}{links}"
        out += [(start + flagged + end, [1, *art, 1, 1, 1, 1]) for start, end in (
            ("<article>", "</article>"), ("<article class='post has-sidebar'>", "</article>"), ("<main class='legal-content'>", "</main>"),
            ("<form id='form1'><article>", "</article></form>"))]
        out += [
            # boxes in an article whose name hints at something else: links decide
            (f"<article>{text}<section class='legal'><h2>Law</h2>{note}</section><div class='form-field'>{note}</div>"
             f"<div class='widget'>{menu}</div></article>", [*art, 1, 1, 1, 0, 0, 0]),
            (f"<main>{text}<div class='discussion'>{note}{note}</div><ul class='no-nav'><li>{_words(other)}</li></ul></main>", [*art, 1, 1, 1]),
            (f"<div class='legal'>{note}</div><article>{text}</article><div class='widget'>{note}</div>", [0, *art, 0]),
            (f"<div class='sidenav'>{menu}</div><article>{text}<div class='relatedPosts'>{links}</div></article><div class='cookieBanner'>{note}</div>",
             [0, 0, 0, *art, 0, 0, 0, 0, 0]),
            # comments: longer than the text, without a name
            (f"<article>{text}<section class='comments'>{note}{text}{text}</section></article>", [*art, 0, *[0] * 2 * len(art)]),
            (f"<article>{text}<article>{note}</article></article>", [*art, 0]),
            (f"<article>{text}<h2>Comments</h2><ol><li>{_words(other)}</li><li>{_words(30)}</li></ol></article>", [*art, 0, 0, 0]),
            (f"<div class='with-sidebar'>{menu}<p>{_words(45)}</p><p>{_words(60 + other)}</p><p>{_words(30)}</p></div>", [0, 0, 0, 1, 1, 1]),
            (f"<form id='form1'><div class='menu'>{menu}</div><article>{text}</article><div class='sidebar'>{note}</div></form>", [0, 0, 0, *art, 0]),
            (f"<p>{_words(60)}</p><p>{_words(80)}</p><div class='comments'><p>{_words(70)}</p><p>{_words(60)}</p><p>{_words(30 + other)}</p></div>", [1, 1, 0, 0, 0]),
        ]
    return [*out, ("<p>Hello there.</p>", [1]), ("Only text, without any element around it.", [1])]


class Tree:
    """Binary decision tree by Gini impurity: (feature, cut, left, right) or a
    label.  Ties go to the first feature and the lowest cut."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 6):
        self.root = self._grow(x, y, depth)

    def _grow(self, x, y, depth):
        if depth == 0 or len(set(y.tolist())) < 2:
            return int(2 * y.sum() > len(y))
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[:-1] + values[1:]) / 2:
                left = x[:, f] <= cut
                cost = sum(len(p) * 2 * p.mean() * (1 - p.mean()) for p in (y[left], y[~left]))
                if best is None or cost < best[0] - 1e-12:
                    best = (cost, f, cut, left)
        if best is None:
            return int(2 * y.sum() > len(y))
        _, f, cut, left = best
        return f, float(cut), self._grow(x[left], y[left], depth - 1), self._grow(x[~left], y[~left], depth - 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)

        def walk(node, rows):
            if not len(rows):
                return
            if isinstance(node, int):
                out[rows] = bool(node)
                return
            f, cut, left, right = node
            low = x[rows, f] <= cut
            walk(left, rows[low])
            walk(right, rows[~low])

        walk(self.root, np.arange(len(x)))
        return out


@lru_cache(maxsize=1)
def trained() -> Tree:
    xs, ys = [], []
    for page, labels in labelled_pages():
        b = blocks(page)
        if len(b) != len(labels):
            raise ValueError(f"{len(labels)} labels for {len(b)} blocks: {page[:80]}")
        xs.append(features(b))
        ys += labels
    return Tree(np.vstack(xs), np.array(ys))


def main_text(page: str | None, tree: Tree) -> str:
    b = blocks(page)
    if not b:
        return ""
    return "\n".join(x.text for x, keep in zip(b, tree.predict(features(b))) if keep)


def extracted(df: DataFrame, html_col: str = "html", keep: list[str] | None = None, out_col: str = "text") -> DataFrame:
    """The columns ``keep`` (all by default) of ``df`` with the main text."""
    names = df.columns if keep is None else keep
    two = pick(df, **{f"k{i}": c for i, c in enumerate(names)}, html=html_col)
    tree = trained()
    schema = T.StructType([*two.schema.fields[:-1], T.StructField("text", T.StringType())])

    def run(batches):
        for b in batches:
            out = [main_text(p, tree) for p in b.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.string())], schema.names)

    return map_arrow(two, run, schema).toDF(*names, out_col)


def op2_block_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = extracted(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return t.selectExpr("page_id", "url", "text", "cast(char_length(text) AS bigint) AS n_chars")


QUERIES = {"op2_block_tree": op2_block_tree}
SQL: dict[str, str] = {}
