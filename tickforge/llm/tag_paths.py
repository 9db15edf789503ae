"""Main-text extraction by tag-path ratios.

Every text node of a page belongs to the path of open tags from the root to
it. Over a page, text length, punctuation, node count and linked characters
are added up per tag path; a path's ratio (text per node, raised by punctuation
and lowered by links) is fused with the ratio smoothed over neighbouring
nodes in page order, and paths whose ratio reaches a share of the mean over the page's text are content.
Where the page names its article or main element, ratios compete inside it.
Elements that never hold main text (menus, headers, footers, asides, forms, dialogs, scripts,
styles, hidden ones) are taken out by element, role or attribute. A class or id name made of words for adverts,
notices, teasers and the like alone takes an element out, however much text it holds, unless an article or main
element is inside; one made of words for reader comments takes it out in any case. An article element with such
a name is a comment or teaser itself. A name that only contains such a word lowers the ratio of its paths.
A page with no text but links outside such elements keeps what stands under names that may be its subject.

Defined results: of paths with equal ratios all are kept or none; null, empty or text-free html gives an empty text; broken or
cut-off markup is read as far as it goes; repeated pages repeat; very long pages
are read whole in one pass; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as _html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import in_parts

# HTML element classes.
RAW = frozenset("script style textarea title noscript template iframe svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr img".split())
BOILERPLATE = frozenset("nav footer aside form button select option input label dialog menu head fieldset".split())
BLOCK_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
                         "main nav ol p pre section table ul figure figcaption details".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tr", "td", "th")}
CONTENT_ROLES = ("article", "main")
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
# Words of class and id names that mark an element as something other than the article.
MARKS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav "
                  "navbar navigation menu submenu breadcrumb breadcrumbs pagination pager sidebar side aside rail "
                  "footer foot header masthead topbar cookie cookies consent gdpr notice alert popup modal overlay "
                  "newsletter subscribe subscription signup login comment comments commentlist disqus reply replies "
                  "discussion respond share sharing social related recommended recommendations trending widget "
                  "toolbar copyright legal disclaimer skip hidden form search tags teaser teasers".split())
# Those for what readers write, and those that an article element of its own may bear.
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
ASIDE_ARTICLES = COMMENTS | frozenset("teaser teasers related recommended recommendations promo promotion sponsored "
                                      "sponsor ad ads advert advertisement trending widget".split())
# Marks that can also name what a page is about.
SUBJECTS = frozenset("legal copyright disclaimer notice alert search form tags widget overlay hidden".split())
# Words that say how an element is laid out, not what it is.
LAYOUT = frozenset("list area section block box container wrap wrapper inner outer content item items thread".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                  r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+")
_PUNCT = re.compile(r"[.,;:!?…。，、；：！？।،؛؟]")
_BLANK = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

SMOOTH = 2          # neighbours on either side
THRESHOLD = 0.2     # share of the mean smoothed ratio of the page's text
NAMED = 0.1         # part of that share asked for inside a named article
DOUBT = 0.5         # of a path's ratio lost where all its text lies under names that contain a mark


APART, TALK, NAME, LOOSE, PART = 5, 4, 3, 2, 1


def _named(words: list[str], tag: str) -> int:
    """What a class or id name of ``words`` says: TALK for reader comments (words of layout beside them do not
    count), NAME for other marks, LOOSE for those that may name a page's own subject, PART if it only
    contains a mark, else 0."""
    telling = [w for w in words if w not in LAYOUT]
    if telling and COMMENTS.issuperset(telling):
        return TALK
    if tag == "article":
        return NAME if telling and ASIDE_ARTICLES.issuperset(telling) else 0
    if words and MARKS.issuperset(words):
        return LOOSE if SUBJECTS.issuperset(words) else NAME
    return PART if not MARKS.isdisjoint(words) else 0


def _marked(tag: str, attrs: str) -> int:
    """Whether an element is set apart from the article: APART by its name, role or being hidden, else
    the most that its class and id names say."""
    if tag in BOILERPLATE:
        return APART
    found = 0
    if not attrs or attrs.isspace():
        return found
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return APART
        if name == "style" and _HIDDEN.search(value):
            return APART
        if name == "role" and value in ROLES:
            return APART
        if name in ("class", "id") and tag not in ("body", "html", "main"):
            for words in map(_NAME.findall, value.split()):
                found = max(found, _named(words, tag))
    return found


def _nodes(page: str):
    """Text nodes in page order, (path, block, raw text, in article, link, set apart, named, in
    doubt), and of each element with a marked name (element around it, holds an article, mark).
    ``block`` numbers the runs of inline content, ``named`` is the innermost such element (-1: none)."""
    stack: list[tuple] = []      # (tag, path, in article, in link, set apart, named, in doubt)
    path, inside, link, apart, named, doubt = "", False, False, False, -1, False
    elements: list[list] = []
    block, cut, n = 0, 0, len(page)
    out = []

    def pop_to(depth):
        nonlocal path, inside, link, apart, named, doubt
        while len(stack) > depth:
            _, path, inside, link, apart, named, doubt = stack.pop()

    while cut < n:
        m = _TAG.search(page, cut)
        start = m.start() if m else n
        if start > cut:
            out.append((path, block, page[cut:start], inside, link, apart, named, doubt))
        if not m:
            break
        cut = m.end()
        tag = m[2]
        if tag is None:
            if page.startswith("<![CDATA[", m.start()):
                out.append((path, block, page[m.start() + 9:m.end()].removesuffix("]]>"), inside, link, apart, named, doubt))
            continue
        tag = tag.lower()
        if m[1]:                                       # an end tag closes what it opened
            if tag not in INLINE:
                block += 1
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop_to(k)
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break                              # stray end tag of an inline element
            continue
        if tag not in INLINE:
            block += 1
        if tag in VOID:
            continue
        if tag in RAW and not m[3].endswith("/"):      # skipped up to its end tag, whatever it holds
            e = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, cut)
            cut = e.end() if e else n
            continue
        shut = ("p",) if tag in BLOCK_ENDS_P else CLOSES.get(tag, ())
        if shut:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in shut:
                    pop_to(k)
                    break
                if stack[k][0] not in INLINE and stack[k][0] not in shut:
                    break
        if m[3].endswith("/") and tag not in BLOCK_ENDS_P:
            continue
        stack.append((tag, path, inside, link, apart, named, doubt))
        path = f"{path}/{tag}"
        mark = _marked(tag, m[3])
        apart = apart or mark == APART or tag == "header" and not inside
        article = mark < LOOSE and (tag in CONTENT_ROLES or "role" in m[3] and any(
            x[1].lower() == "role" and (x[2] or x[3] or x[4] or "").lower() in CONTENT_ROLES for x in _ATTR.finditer(m[3])))
        if article:
            inside, doubt, e = True, False, named
            while e >= 0 and not elements[e][1]:
                elements[e][1] = True
                e = elements[e][0]
        elif mark >= LOOSE:
            elements.append([named, False, mark])
            named = len(elements) - 1
        elif mark == PART:
            doubt = True
        link = link or tag == "a"
    return out, elements


def _kept_nodes(page: str) -> list[tuple]:
    """(path, block, text, in article, link, in doubt) of the text nodes that nothing sets apart."""
    nodes, elements = _nodes(page)
    nodes = [(p, b, _html.unescape(t) if "&" in t else t, *rest) for p, b, t, *rest in nodes]
    out, sure = [], []                                   # elements follow the one around them
    for around, article, mark in elements:
        gone = mark == TALK or not article
        out.append(around >= 0 and out[around] or gone)
        sure.append(around >= 0 and sure[around] or gone and mark != LOOSE)
    left = [x for x in nodes if not x[5]]
    kept = [x for x in left if x[6] < 0 or not out[x[6]]]
    if not any(x[2].strip() and not x[4] for x in kept):
        kept = [x for x in left if x[6] < 0 or not sure[x[6]]]
    return [(p, b, t, inside, link, doubt or named >= 0) for p, b, t, inside, link, apart, named, doubt in kept]


def extract(page: str, threshold: float = THRESHOLD, smooth: int = SMOOTH) -> str:
    """Main text of one page."""
    nodes = _kept_nodes(page)
    if any(inside and t.strip() for _, _, t, inside, _, _ in nodes):
        nodes = [x for x in nodes if x[3]]
    text, marks, linked, count, doubted = (defaultdict(int) for _ in range(5))
    # Aggregates per root-to-leaf path; inline wrappers belong to the path of their block.
    leaf = {p: re.sub(r"(?:/(?:%s))+$" % "|".join(sorted(INLINE)), "", p) for p in {x[0] for x in nodes}}
    filled = [k for k, x in enumerate(nodes) if x[2].strip()]
    for k in filled:
        p, _, t, _, link, doubt = nodes[k]
        p, size = leaf[p], len(_BLANK.sub(" ", t).strip())
        text[p] += size
        marks[p] += len(_PUNCT.findall(t))
        linked[p] += size * link
        doubted[p] += size * doubt
        count[p] += 1
    ratio = {p: (text[p] / count[p]) * (1 + marks[p]) / (1 + count[p]) * (1 - linked[p] / text[p])
             * (1 - DOUBT * doubted[p] / text[p]) for p in text}
    own = [ratio[leaf[nodes[k][0]]] for k in filled]
    if not own:
        return ""
    # Smoothed over neighbouring nodes in page order by running sums.
    sums = [0.0]
    for r in own:
        sums.append(sums[-1] + r)
    flat = [(sums[min(len(own), i + smooth + 1)] - sums[max(0, i - smooth)])
            / (min(len(own), i + smooth + 1) - max(0, i - smooth)) for i in range(len(own))]
    # Fused per path: what a path holds itself and what stands around its nodes.
    fused, seen = defaultdict(float), defaultdict(int)
    for i, k in enumerate(filled):
        p = leaf[nodes[k][0]]
        fused[p] += (own[i] + flat[i]) / 2
        seen[p] += 1
    # The mean is one of the text: many short nodes do not lower it. Inside a named article a path has
    # less to prove.
    size = [len(nodes[k][2].strip()) for k in filled]
    limit = threshold * (NAMED if nodes[filled[0]][3] else 1) * sum(map(float.__mul__, flat, map(float, size))) / sum(size)
    content = {p for p in fused if fused[p] / seen[p] >= limit and linked[p] <= 0.5 * text[p]}
    blocks, at = [], None
    for p, b, t, *_ in nodes:
        if leaf[p] in content:
            if b != at:
                blocks.append([])
                at = b
            blocks[-1].append(t)
    done = (_BLANK.sub(" ", "".join(b)).strip() for b in blocks)
    return " ".join(b for b in done if b)


def extract_pages(pages: DataFrame, threshold: float = THRESHOLD, smooth: int = SMOOTH) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``; a narrow map over whole pages."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for batch in batches:
            for part in in_parts(batch, "html"):
                texts = [extract(h, threshold, smooth) if h else "" for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
