"""Main text of web pages by a site style tree.

Pages of one host are merged into one tree of element paths. For every path Spark counts, over
all pages of the host that have it, how often each arrangement of children (presentation) and
each content occurs. Importance is the entropy of these counts, as a share of what it could be:
a branch that looks and reads the same on page after page is near 0, one that differs from page
to page near 1. Branches of low importance leave every page of the host, inside articles too.
Pages of one host that read the same are one page in the counts: that a text is there twice
does not make its parts boilerplate.

What an element says of itself comes before counts: menus, footers, adverts and the like are of
no importance under any content. Inside an article or main part most names are only a hint
(a section on search, social or legal matters may have them): a branch with such a name leaves
when counts confirm it, at a higher importance than others. The article element itself is not judged, nor are headings
and other labels on their own, and an article that pages repeat as a whole stays. Pages are
read twice, in narrow passes; what is shuffled is a few numbers per page and path.

Of what is then left of a page, its articles, its main part and the rest are weighed by their
text, linked text for little: an article element is the main text unless others outweigh it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import written

#: Branches below this importance are removed, where at least so many pages show them.
LOW_IMPORTANCE, LEAST_PAGES = 0.3, 4
#: The same for branches in landmarks whose names hint at noise.
NAMED_IMPORTANCE = 0.7
#: Weight of content against presentation in a branch's importance.
CONTENT_WEIGHT = 0.9
#: Text counts so many times as much as linked text; what is outside of all landmarks is kept
#: where it outweighs them so many times.
UNLINKED, OUTSIDE = 10, 2
#: Noise branches (16 bytes each) up to this number go to all executors; beyond it they are
#: joined to the pages instead.
BROADCAST_BRANCHES = 500_000

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr img".split()
)
RAW = frozenset("script style template textarea title iframe noembed noframes xmp".split())
#: Where the main text is, and which of two of them says it better.
LANDMARKS = {"main": 1, "article": 2}
#: Elements that belong to what they stand beside; in a landmark they only go with it.
LABELS = frozenset("h1 h2 h3 h4 h5 h6 th dt caption figcaption summary legend label".split())
#: Elements that hold the whole page, whatever their class names say.
WHOLE = frozenset("html body main".split())
NOISE_TAGS = frozenset(
    "nav footer aside form script style noscript template iframe object embed svg canvas"
    " button select textarea dialog menu head title".split()
)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu"
    " menubar toolbar tablist".split()
)
# Words of class names and ids that name what is not the article.
NOISE_WORDS = frozenset(
    "ad ads adbox adslot adunit alert alerts adv advert adverts advertisement advertising adsense sponsor sponsored promo"
    " promotion banner banners cookie cookies consent gdpr notice notices notification popup"
    " modal overlay newsletter subscribe subscription signup login menu menus nav navbar"
    " navigation sidenav submenu topnav breadcrumb breadcrumbs pagination pager sidebar sidebars widget widgets footer"
    " masthead topbar toolbar comment comments commentlist reply replies respond responses discussion"
    " disqus share sharing social related recommended recommendations copyright legal"
    " disclaimer search skip".split()
)
# Those of them that an article may be about; in landmarks they are hints only.
DOUBTFUL_WORDS = frozenset(
    "alert alerts advertising banner banners consent cookie cookies copyright disclaimer discussion legal"
    " login menu menus navigation notice notices notification notifications overlay promotion"
    " recommended recommendations related reply replies respond responses search share sharing"
    " skip social sponsor subscription widget widgets".split()
)
SURE_WORDS = NOISE_WORDS - DOUBTFUL_WORDS
# Class names of these words alone are sure even so, or of doubtful words beside parts of a page.
SHARE_WORDS = frozenset(["share", "sharing"])
PART_WORDS = frozenset("bar box button buttons icon icons links tools".split())
HEADER_WORDS = frozenset(["header"])
#: Words of class names and ids of articles that only lead to others.
CARD_WORDS = frozenset("card cards teaser teasers tile tiles preview previews".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1"
    " h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SAME_LEVEL = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
#: Elements that an unclosed element of the same kind does not reach across.
FENCES = frozenset("ul ol dl table select article main section div body td th".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Names that tell what is in or around an element, not what it is.
_ABOUT = re.compile(r"(?:has|with|no|is)[-_]")
_DIGITS = re.compile(r"\d+")


def host_of(url: str | None) -> str:
    found = re.search(r"//(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    return found[1].lower() if found else ""


def _mixed(a: int, b: int) -> int:
    return xxhash.xxh3_64_intdigest(a.to_bytes(8, "little") + b.to_bytes(8, "little"))


def _hashed(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))


class Element:
    """An open element: where it is in the site's tree, what it says of itself, and hashes of
    its children's arrangement and of its content so far. ``article`` is the number of the
    outermost article it is in, 0 for none; ``card`` says that this one is named a card, and
    ``named`` that the element's own name hints at noise without being sure."""

    __slots__ = (
        "tag", "path", "noise", "landmark", "children", "content", "article", "card", "linked", "heading", "named"
    )

    def __init__(self, tag: str, path: int, noise: bool, landmark: int):
        self.tag, self.path, self.noise, self.landmark = tag, path, noise, landmark
        self.children = self.content = self.article = 0
        self.card = self.linked = self.heading = self.named = False


def _words(name: str) -> set[str]:
    return {word.lower() for word in _NAME_PARTS.findall(name)}


def _sure(tag: str, classes: list[set[str]], id_words: set[str]) -> bool:
    """Whether names in a landmark leave no doubt, from words of each class name and the id."""
    if tag in HEADINGS:
        id_words = set()  # made of the heading's text
    for words in (*classes, id_words):
        sure = words & SURE_WORDS
        if tag in INLINE:
            sure.discard("comment")  # of coloured program text
        if sure:
            return True
    return any(
        words
        and (
            words <= SHARE_WORDS
            or words <= DOUBTFUL_WORDS | PART_WORDS and words & DOUBTFUL_WORDS and words & PART_WORDS
        )
        for words in classes
    )


def _describe(
    tag: str, attributes: str, inside: bool
) -> tuple[str, bool, bool, set[str] | frozenset[str]]:
    """An element's style label, whether its tag, role, class or id call it noise, whether
    names only hint at it, and the words of its class names and id. ``inside``: it is, or is
    in, an article or main part, which may have a header of its own."""
    noise, named = tag in NOISE_TAGS, False
    header = tag == "header"
    label, words = tag, frozenset()
    if attributes and not attributes.isspace():
        found = {}
        for name, value in _ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
        style = " ".join(filter(None, (found.get("class"), found.get("id"))))
        if style:
            label = f"{tag}.{_DIGITS.sub('', style)}"
            if tag not in WHOLE:
                classes, ids = (
                    [_words(name) for name in (found.get(key) or "").split() if not _ABOUT.match(name)]
                    for key in ("class", "id")
                )
                words = set().union(*classes, *ids)
                if not words.isdisjoint(NOISE_WORDS):
                    sure = not inside or _sure(tag, classes, set().union(*ids))
                    noise, named = noise or sure, not sure
                header = header or not words.isdisjoint(HEADER_WORDS)
        roles = found.get("role", "").lower().split()
        noise = noise or not NOISE_ROLES.isdisjoint(roles)
        noise = noise or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
    return label, noise or header and not inside, named, words


def walk(page: str) -> Iterator[tuple[str, Element | None, list[Element], str]]:
    """Events of a page in order: ``("close", element, stack, "")`` when an element ends, and
    ``("text", None, stack, text)`` for text, decoded; ``("break", ...)`` where a block begins
    or ends. Missing end tags are made up for; nothing raises on broken markup."""
    stack = [Element("", 0, False, 0)]
    at, size, articles = 0, len(page), 0

    def pop_to(depth: int):
        while len(stack) > depth:
            element = stack.pop()
            yield "close", element, stack, ""
            if element.tag not in INLINE:
                yield "break", None, stack, ""

    while at < size:
        mark = _MARKUP.search(page, at)
        start = mark.start() if mark else size
        if start > at:
            yield "text", None, stack, html.unescape(page[at:start])
        if not mark:
            break
        at = mark.end()
        closing, name, attributes = mark.groups()
        if name is None:
            continue
        tag = name.lower()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    yield from pop_to(depth)
                    break
            continue
        if tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    yield from pop_to(depth)
                    break
                if stack[depth].tag in FENCES:
                    break
        elif tag in SAME_LEVEL:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in SAME_LEVEL[tag]:
                    yield from pop_to(depth)
                    break
                if stack[depth].tag in FENCES and stack[depth].tag not in SAME_LEVEL[tag]:
                    break
        if tag not in INLINE:
            yield "break", None, stack, ""
        parent = stack[-1]
        landmark = max(parent.landmark, LANDMARKS.get(tag, 0))
        label, noise, named, words = _describe(tag, attributes, landmark > 0)
        code = _hashed(label)
        parent.children = _mixed(parent.children, code)
        element = Element(tag, _mixed(parent.path, code), parent.noise or noise, landmark)
        element.article, element.card = parent.article, parent.card
        if tag == "article" and not parent.article:
            articles += 1
            element.article, element.card = articles, not words.isdisjoint(CARD_WORDS)
        element.named = named
        element.linked = parent.linked or tag == "a"
        element.heading = parent.heading or tag in HEADINGS
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = end.start() if end else size
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in INLINE | CLOSES_P:
            continue
        stack.append(element)
    yield from pop_to(1)


def _judged(element: Element) -> bool:
    """Whether counts decide on an element: not if it calls itself noise, nor on landmarks, nor
    inside them on labels, and on parts of a line only where names hint at noise."""
    if element.noise or element.tag in LANDMARKS:
        return False
    if not element.landmark:
        return True
    return element.tag not in LABELS and (element.named or element.tag not in INLINE)


def branches(page: str) -> tuple[int, dict[int, tuple[int, int, int]]]:
    """The page's content without noise, and path -> (arrangement of children, content, 1 if
    names hint at noise) of the branches that need counts."""
    found: dict[int, tuple[int, int, int]] = {}
    body = 0
    for kind, element, stack, text in walk(page):
        if kind == "text":
            if text and not text.isspace():
                stack[-1].content = _mixed(stack[-1].content, _hashed(" ".join(text.split())))
        elif kind == "close":
            if element.content and not element.noise:
                stack[-1].content = _mixed(stack[-1].content, element.content)
            if element.content and _judged(element):
                before = found.get(element.path, (0, 0))
                found[element.path] = (
                    _mixed(before[0], element.children),
                    _mixed(before[1], element.content),
                    int(element.named),
                )
        body = stack[0].content
    return body, found


def _chosen(weights: dict[int, int], cards: set[int]) -> set[int]:
    """The parts of a page that are its main text, of their weights: numbers of articles, 0 for
    the rest of the main part, -1 for what is outside of all landmarks."""
    articles = [part for part in weights if part > 0]
    best = max((weights[part] for part in articles), default=0)
    main, outside = weights.get(0, 0), weights.get(-1, 0)
    chosen = set()
    if main > best:
        chosen.add(0)
    if outside > OUTSIDE * max(main, best):
        chosen |= {0, -1}
    # Where the body is elsewhere, articles that only lead to others go; in doubt all stay.
    elsewhere = sum(weights.get(part, 0) for part in chosen)
    if chosen and elsewhere > sum(weights[part] for part in articles):
        articles = [part for part in articles if part not in cards]
    return chosen.union(articles)


def main_text(page: str, low: set[int] | frozenset[int]) -> str:
    """The text of a page without noise and without the branches ``low``, of those of its
    articles, main part and rest that outweigh the others, and in the main part what stands
    from a heading on before a chosen article. Where its landmarks hold nothing but ``low``
    branches, these stay there."""
    texts: list[tuple[int | None, str]] = []  # part of the page, text; None: a break
    heads: dict[int, int] = {}  # place in texts -> article that it stands before
    waiting: list[int] = []
    weights: dict[int, int] = {}
    linked: dict[int, int] = {}
    cards: set[int] = set()
    landmarks = False
    for kind, _, stack, text in walk(page):
        if kind == "break":
            texts.append((None, " "))
        elif kind == "text" and not stack[-1].noise:
            element = stack[-1]
            size = sum(map(len, text.split()))
            landmarks = landmarks or element.landmark > 0 and size > 0
            if low and not low.isdisjoint(e.path for e in stack):
                continue
            part = element.article or (0 if element.landmark else -1)
            texts.append((part, text))
            if not size:
                continue
            weights[part] = weights.get(part, 0) + size * (1 if element.linked else UNLINKED)
            if part > 0:
                if element.linked:
                    linked[part] = linked.get(part, 0) + size
                if element.card:
                    cards.add(part)
                heads.update(dict.fromkeys(waiting, part))
                waiting = []
            elif part == 0 and (element.heading or waiting):
                waiting.append(len(texts) - 1)
    if landmarks and low and not any(part >= 0 for part in weights):
        return main_text(page, frozenset())
    # An article that is linked for half of its text or more is a card as well.
    cards.update(part for part, n in linked.items() if UNLINKED * n >= weights[part] - n)
    chosen = _chosen(weights, cards)
    kept = [
        text for at, (part, text) in enumerate(texts)
        if part is None or part in chosen or heads.get(at) in chosen
    ]
    return " ".join("".join(kept).split())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _branch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page", "host", "path", "arrangement", "content", "named", "body"]
    for batch in batches:
        rows = []
        for key, url, page in zip(*batch.columns):
            host = host_of(url.as_py())
            if host and page.is_valid:
                code = _signed(_hashed(host))
                body, found = branches(page.as_py())
                for path, seen in found.items():
                    rows.append((key.as_py(), code, *map(_signed, (path, *seen, body))))
        columns = zip(*rows) if rows else [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)




def _text_batches(batches: Iterator[pa.RecordBatch], low) -> Iterator[pa.RecordBatch]:
    """Columns key, page_id, url, html and, where branches are joined, the page's own."""
    shared = low.value if low is not None else None
    for batch in batches:
        texts = []
        columns = [batch.column(2), batch.column(3)]
        own = batch.column(4) if shared is None else [None] * len(batch)
        for url, page, paths in zip(*columns, own):
            text = page.as_py() or ""
            if shared is None:
                noise = {path % (1 << 64) for path in paths.as_py() or []}
            else:
                noise = shared.get(_signed(_hashed(host_of(url.as_py()))), frozenset())
            texts.append(main_text(text, noise))
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), batch.column(2), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def _entropy(counted: DataFrame, column: str) -> DataFrame:
    """Per host and path the entropy of a column over the pages, to the base of their number:
    0 where all pages agree, 1 where all differ."""
    groups = counted.groupBy("host", "path", column).agg(
        F.sum("pages").alias("n"), F.max("named").alias("named")
    )
    whole = F.sum("n")
    # -sum(p log p) with p = n / whole, from sums that combine before the shuffle.
    bits = F.log2(whole) - F.sum(F.col("n") * F.log2("n")) / whole
    return groups.groupBy("host", "path").agg(
        whole.alias("pages"),
        F.max("named").alias("named"),
        F.when(whole > 1, bits / F.log2(whole)).otherwise(1.0).alias(f"{column}_entropy"),
    )


def low_branches(seen: DataFrame) -> DataFrame:
    """``host, path`` of the branches of low importance, from rows of pages and paths."""
    counted = seen.groupBy("host", "path", "arrangement", "content", "named").agg(
        F.count_distinct("body").alias("pages")
    )
    counted = written(counted, "style-tree")
    # Names are part of a path, so all pages agree on ``named``.
    both = _entropy(counted, "arrangement").join(
        _entropy(counted, "content").drop("pages", "named"), ["host", "path"]
    )
    importance = (1 - CONTENT_WEIGHT) * F.col("arrangement_entropy") + CONTENT_WEIGHT * F.col("content_entropy")
    low = F.when(F.col("named") > 0, NAMED_IMPORTANCE).otherwise(LOW_IMPORTANCE)
    return both.where((F.col("pages") >= LEAST_PAGES) & (importance < low)).select("host", "path")


def extract_text(
    pages: DataFrame, id_column: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """Every page as id, url, ``text`` and ``n_chars``, its code points.

    NULL or empty html gives an empty text. A page without a host is a site of its own, so
    nothing is counted for it. Rows may repeat, ids may be NULL; other columns are not read.
    """
    rows = pages.select(
        F.xxhash64(url, page).alias("page"),
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.col(page).cast("string").alias("html"),
    )
    seen = written(
        rows.select("page", "url", "html").mapInArrow(
            _branch_batches, "page long, host long, path long, arrangement long, content long, named long, body long"
        ),
        "style-branches",
    )
    low = written(low_branches(seen), "style-noise")
    if low.count() <= BROADCAST_BRANCHES:
        by_host: dict[int, set[int]] = {}
        for host, path in low.toLocalIterator():
            by_host.setdefault(host, set()).add(path % (1 << 64))
        sent = pages.sparkSession.sparkContext.broadcast(by_host)
        found = rows.mapInArrow(partial(_text_batches, low=sent), "page_id long, url string, text string")
    else:
        # A page's own noise is at most as long as the page; equal pages share it.
        own = (
            seen.join(low, ["host", "path"])
            .groupBy("page")
            .agg(F.collect_set("path").alias("paths"))
        )
        found = rows.join(own, "page", "left").mapInArrow(
            partial(_text_batches, low=None), "page_id long, url string, text string"
        )
    return found.select(
        F.col("page_id").alias(id_column),
        F.col("url").alias(url),
        "text",
        F.length("text").cast("long").alias("n_chars"),
    )
