"""Main text of web pages: tokens of same-host pages with equal occurrence vectors form classes, valid classes nest into a
template, and the slots that remain are extracted."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import broadcast_if_small, measured, quoted, text_of, whole_row
from navloom.session import cut_lineage

#: A template token stands on at least this share of a host's pages, and on as many pages as LEAST_PAGES.
SHARE = 0.5
LEAST_PAGES = 3
#: Tokens that a class needs to count as a part of the template.
LEAST_CLASS = 2
#: Times the classes of all hosts are held against the pages; what is not settled by then is no part of a template.
ROUNDS = 8

# Names of HTML elements and usual names of page parts.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
KEEPS = {"ul", "ol", "dl", "table", "article", "section", "div", "main", "aside", "nav", "header", "footer", "blockquote", "body", "html", "form"}
SIDE_TAGS = {"nav", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe", "svg", "math", "canvas", "object", "button", "select", "option", "textarea", "head", "title", "dialog", "menu", "audio", "video", "map"}
SIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
SIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disclaimer", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "overlay", "pager", "pagination", "popup", "promo", "promoted", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "teaser", "toolbar", "widget"}
#: Words that beside one of SIDE_WORDS leave a name a page part's ("share-buttons", not "share-price").
PLAIN_WORDS = {"0", "area", "article", "articles", "aside", "bar", "block", "body", "bottom", "box", "button", "buttons", "card", "cards", "col", "column", "container", "content", "extra", "form", "global", "group", "head", "header", "holder", "icon", "icons", "inner", "item", "items", "js", "left", "link", "links", "list", "main", "mobile", "module", "outer", "page", "panel", "post", "posts", "primary", "right", "row", "secondary", "section", "site", "slot", "small", "sticky", "story", "stories", "text", "title", "top", "unit", "wrap", "wrapper", "wrapped"}
MAIN_NAMES = {"article-body", "article-content", "article-text", "articlebody", "entry-content", "main-content", "post-body", "post-content", "story-body"}

TOKEN = re.compile(
    r"<!--(?:.*?-->|>|->|.*\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?:(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(?P<loose>[^>]*+)(?:>|\Z))"
    r"|(?P<text>[^<]++)|(?P<mark><)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[a-z0-9]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

#: What an event of a page is, if no text.
OPENS, CLOSES = 0, -1


@dataclass(slots=True)
class Element:
    tag: str
    key: int  # hash of the labels from the root to here
    parent: int  # place in the page's list, -1 for the root
    depth: int
    side: bool  # part of a page's frame, or inside of one
    main: int  # 0, or how plainly it, or one around it, is marked as the article
    link: bool


@dataclass
class Page:
    """Elements in the order they open, text nodes (place of the element, text, number of the block), and what follows what:
    the place of an element with OPENS or CLOSES, or with the number of its text, from 1."""

    elements: list[Element] = field(default_factory=list)
    texts: list[tuple[int, str, int]] = field(default_factory=list)
    events: list[tuple[int, int]] = field(default_factory=list)


def _is_side(name: str) -> bool:
    """Whether a class or id names a part of a page's frame: a word of one, and no word that says otherwise."""
    words = set(WORD.findall(name))
    return bool(words & SIDE_WORDS) and words <= SIDE_WORDS | PLAIN_WORDS


def _element(parent: Element, at: int, tag: str, raw: str) -> Element:
    label, side, main = tag, parent.side or tag in SIDE_TAGS, parent.main
    if raw and not raw.isspace():
        attrs = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(raw)}
        names = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
        if names:
            label += "." + re.sub(r"\d+", "0", ".".join(sorted(names)))
        role = attrs.get("role", "")
        if role == "main" or attrs.get("itemprop") == "articlebody":
            main = max(main, 2)
        elif MAIN_NAMES.intersection(names):
            main = max(main, 1)
        elif role in SIDE_ROLES or any(_is_side(n) or ("header" in WORD.findall(n) and not main) for n in names):
            side = True
        if "hidden" in attrs or HIDDEN.search(attrs.get("style", "")):
            side = True
    if tag == "article":
        main = 3
    elif tag == "main":
        main = max(main, 2)
    elif tag == "header" and not main:
        side = True
    key = xxhash.xxh3_64_intdigest(label, seed=parent.key)
    return Element(tag, key, at, parent.depth + 1, side, main, parent.link or tag == "a")


def read_page(source: str) -> Page:
    root = Element("", 0, -1, 0, False, 0, False)
    page, block, at = Page([root]), 0, 0
    stack = [0]
    open_tags = Counter([""])

    def shut(depth: int) -> None:
        for place in stack[depth:]:
            open_tags[page.elements[place].tag] -= 1
        del stack[depth:]

    def close_one(tags: set[str]) -> None:
        """Closes the innermost of some elements, if none that keeps its contents stands between."""
        if any(open_tags[t] for t in tags):
            for depth in range(len(stack) - 1, 0, -1):
                tag = page.elements[stack[depth]].tag
                if tag in tags:
                    shut(depth)
                    return
                if tag in KEEPS:
                    return

    while at < len(source):
        m = TOKEN.match(source, at)
        at = m.end()
        if m.lastgroup in ("text", "mark"):
            page.texts.append((stack[-1], m[0], block))
            page.events.append((stack[-1], len(page.texts)))
            continue
        name = m["name"]
        if not name:
            if m[0].startswith("<![CDATA["):
                page.texts.append((stack[-1], m[0][9:].removesuffix("]]>").replace("&", "&amp;"), block))
                page.events.append((stack[-1], len(page.texts)))
            continue
        tag = name.lower()
        if tag not in INLINE:
            block += 1
        if m["end"]:
            if open_tags[tag]:
                depth = len(stack) - 1
                while page.elements[stack[depth]].tag != tag:
                    depth -= 1
                page.events.append((stack[depth], CLOSES))
                shut(depth)
            continue
        close_one(ENDS.get(tag, set()))
        if tag not in INLINE and tag in KEEPS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "hr"}:
            close_one({"p"})
        raw = m["attrs"] if m["attrs"] is not None else m["loose"] or ""
        page.elements.append(_element(page.elements[stack[-1]], stack[-1], tag, raw))
        page.events.append((len(page.elements) - 1, OPENS))
        if tag in VOID or (raw.endswith("/") and tag in {"svg", "path"}):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(source, at)
            at = end.start() if end else len(source)
        stack.append(len(page.elements) - 1)
        open_tags[tag] += 1
    return page


def _plain(text: str) -> str:
    return " ".join(html.unescape(text).split())


def _signed(key: int) -> int:
    return key - (1 << 63)


#: The last two bits of a token's name: an element that opens, one that closes, a text.
OPEN, CLOSE, TEXT = 0, 1, 2


def _opened(element: Element) -> int:
    """The name of the token that opens an element."""
    return _signed(element.key & ~3)


def _text_token(element: Element, text: str) -> int:
    """The name of a text at its place."""
    return _signed(xxhash.xxh3_64_intdigest(text, seed=element.key) & ~3) | TEXT


def _tokens(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tokens of every page in their order; texts are tokens too.  An element has the length of all text below it."""
    for frame in frames:
        rows = []
        for host, key, source in zip(frame["host"], frame["key"], frame["html"]):
            page = read_page(source)
            chars, links, names = [0] * len(page.elements), [0] * len(page.elements), {}
            for number, (at, text, _) in enumerate(page.texts, 1):
                element = page.elements[at]
                if not element.side and not text.isspace():
                    text = _plain(text)
                    names[number] = _text_token(element, text)
                    chars[at] += len(text)
                    links[at] += len(text) * element.link
            for at in range(len(page.elements) - 1, 0, -1):
                chars[page.elements[at].parent] += chars[at]
                links[page.elements[at].parent] += links[at]
            tokens, lengths, linked = [], [], []
            for at, what in page.events:
                element = page.elements[at]
                if element.side or (what > 0 and what not in names):
                    continue
                tokens.append(names[what] if what > 0 else _opened(element) | (CLOSE if what == CLOSES else OPEN))
                lengths.append(chars[at] if what == OPENS else 0)
                linked.append(links[at] if what == OPENS else 0)
            rows.append((host, key, tokens, tokens, lengths, linked))
        yield pd.DataFrame(rows, columns=["host", "key", "base", "role", "chars", "links"])


PAGE_TOKENS = "host string, key long, base array<long>, role array<long>, chars array<long>, links array<long>"


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How often a token has a role on a page, and which of the page's tokens of this name is the first that has it."""
    for frame in frames:
        rows = []
        for host, key, bases, roles, chars, links in zip(*(frame[c] for c in ("host", "key", "base", "role", "chars", "links"))):
            seen: dict[int, list[int]] = {}
            before: Counter = Counter()
            for base, role, length, linked in zip(bases.tolist(), roles.tolist(), chars.tolist(), links.tolist()):
                own = seen.setdefault(role, [base, 0, 0, 0, before[base]])
                own[1], own[2], own[3] = own[1] + 1, own[2] + length, own[3] + linked
                before[base] += 1
            rows += [(host, key, role, *own) for role, own in seen.items()]
        yield pd.DataFrame(rows, columns=["host", "key", "role", "base", "n", "chars", "links", "nth"])


def _around(roles: list[int], classes: dict[int, tuple[int, int]]) -> tuple[list[int], dict[int, list[int]], set[int]]:
    """The slot of each token on a page, the lowest and highest rank of each role in its class, and the classes that are not nested.

    ``classes``: class and its size by role.  A class is in order if its tokens come in turns, each once before one comes again.  The slot
    of a token is named by the token of the innermost class around it that came last (0: none).  Of two classes that cross, the
    smaller one is not nested.
    """
    slots, ranks, bad = [], {}, set()
    open_now: dict[int, list] = {}  # class: [size, role that came last, slot around it, roles so far]
    stack: list[int] = []
    for role in roles:
        name, size = classes.get(role, (None, 0))
        if name is None:
            slots.append(open_now[stack[-1]][1] if stack else 0)
            continue
        if name not in open_now:
            open_now[name] = [size, 0, open_now[stack[-1]][1] if stack else 0, set()]
            stack.append(name)
        own = open_now[name]
        if role in own[3]:
            bad.add(name)
        for other in stack[stack.index(name) + 1 :] if stack[-1] != name else ():
            bad.add(min((open_now[other][0], other), (size, name))[1])
        rank = ranks.setdefault(role, [len(own[3]), len(own[3])])
        rank[0], rank[1] = min(rank[0], len(own[3])), max(rank[1], len(own[3]))
        own[1] = role
        own[3].add(role)
        slots.append(own[2])
        if len(own[3]) == size:
            del open_now[name]
            stack.remove(name)
    return slots, ranks, bad | set(open_now)


def _settled(roles: list[int], classes: dict[int, tuple[int, int]]) -> tuple[list[int], dict[int, list[int]], set[int]]:
    """:func:`_around`, with the slots of the classes that are nested on the page."""
    slots, ranks, bad = _around(roles, classes)
    if bad:
        slots = _around(roles, {r: c for r, c in classes.items() if c[0] not in bad})[0]
    return slots, ranks, bad


def _classes_of(frame: pd.DataFrame) -> Iterator[dict[int, tuple[int, int]]]:
    """Class and its size by role, for each page."""
    for roles, names, sizes in zip(frame["in_class"], frame["class"], frame["size"]):
        yield dict(zip(roles.tolist(), zip(names.tolist(), sizes.tolist())))


def _placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What a page says about the roles on it."""
    for frame in frames:
        rows = []
        for host, roles, classes in zip(frame["host"], frame["role"], _classes_of(frame)):
            roles = roles.tolist()
            slots, ranks, bad = _settled(roles, classes)
            seen: dict[int, list[int]] = {}
            for role, slot in zip(roles, slots):
                own = seen.setdefault(role, [slot, slot])
                own[0], own[1] = min(own[0], slot), max(own[1], slot)
            for role, own in seen.items():
                name = classes.get(role, (0, 0))[0]
                rows.append((host, role, name, *own, *ranks.get(role, (0, 0)), name in bad))
        yield pd.DataFrame(rows, columns=["host", "role", "class", "slot", "other_slot", "low", "high", "bad"])


def _split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The tokens of pages with roles told apart by the slot they stand in, where the host has them in several slots."""
    for frame in frames:
        changed = []
        for roles, classes, several in zip(frame["role"], _classes_of(frame), frame["several"]):
            roles, several = roles.tolist(), set(several.tolist()) if several is not None else set()
            slots = _settled(roles, classes)[0] if several else roles
            changed.append([_signed(xxhash.xxh3_64_intdigest(f"{r}:{s}") & ~3) | (r & 3) if r in several else r for r, s in zip(roles, slots)])
        yield frame[["host", "key", "base", "chars", "links"]].assign(role=pd.Series(changed, dtype="object", index=frame.index))[["host", "key", "base", "role", "chars", "links"]]


def _vectors(tokens: DataFrame, sizes: DataFrame) -> DataFrame:
    """The roles that stand on enough pages of their host, with their occurrence vectors."""
    counted = tokens.mapInPandas(_counted, "host string, key long, role long, base long, n long, chars long, links long, nth long")
    on_page = F.xxhash64("key", "n")
    found = counted.groupBy("host", "role").agg(
        F.min("base").alias("base"), F.count(F.lit(1)).alias("pages"), F.max("n").alias("most"), F.sum("n").alias("total"), F.bit_xor(on_page).alias("vector"), F.sum(F.shiftright(on_page, 32)).alias("weight"),
        F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.min("nth").alias("nth"), F.max("nth").alias("last_nth"),
    )
    return measured(found.where(F.col("pages") >= LEAST_PAGES).join(sizes, "host").where(F.col("pages") >= SHARE * F.col("all")).drop("all"))[0]


def deduce_templates(pages: DataFrame) -> DataFrame:
    """By host: ``slots`` (elements that stand once on most pages, and whether links fill them) and ``fixed`` (repeated texts).

    Two tokens have equal occurrence vectors when the hashes of (page, count) of all pages where they stand have the same
    exclusive or, and the same sum; such tokens, if they stand on enough pages of their host, form a class.  Each page then says whether the classes are
    valid: the tokens of one come in the same order, in turns, on every page, and two classes lie beside each other, or one in a slot between
    two tokens of the other.  Tokens that change their rank leave their class, classes that are not in turns or cross larger ones are given up, to be formed
    again of the tokens that share a slot.  A token that stands in several slots gets a role in each, with a vector of its own.  This is
    repeated until no page objects and no role is new.  ``nth`` tells apart the tokens of one name (-1: all of them).
    """
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("all"))
    tokens = cut_lineage(pages.select("host", "key", "html").mapInPandas(_tokens, PAGE_TOKENS))
    spark = pages.sparkSession
    vectors = names = _vectors(tokens, sizes)
    wanted = names.groupBy("host").agg(F.collect_set("role").alias("wanted"))
    tokens, slots, banned = _supported(tokens, wanted), spark.createDataFrame([], "host string, role long, slot long"), spark.createDataFrame([], "of string, name long")
    for _ in range(ROUNDS):
        known = vectors.join(slots, ["host", "role"], "left").withColumn("class", F.xxhash64("vector", "weight", F.coalesce("slot", F.lit(0))))
        known = known.join(banned, (F.col("host") == F.col("of")) & ((F.col("role") == F.col("name")) | (F.col("class") == F.col("name"))), "left_anti")
        classes = known.groupBy("host", "class").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= LEAST_CLASS)
        members = known.join(classes, ["host", "class"]).groupBy("host").agg(F.collect_list(F.struct("role", "class", "size")).alias("members"))
        members, n = measured(members.select("host", F.col("members.role").alias("in_class"), F.col("members.class").alias("class"), F.col("members.size").alias("size")))
        on_pages = tokens.join(broadcast_if_small(members, n), "host")
        said = on_pages.mapInPandas(_placed, "host string, role long, class long, slot long, other_slot long, low long, high long, bad boolean")
        said = said.groupBy("host", "role").agg(F.max("class").alias("class"), F.min("slot").alias("slot"), F.max("other_slot").alias("other_slot"), (F.max("high") - F.min("low")).alias("moves"), F.max("bad").alias("bad"))
        said = cut_lineage(said)
        faults = said.where("class <> 0").groupBy("host", "class").agg(F.max("bad").alias("bad"), F.max("moves").alias("most_moves"))
        restless = said.drop("bad").join(faults, ["host", "class"]).where("NOT bad AND moves > 0 AND 2 * moves >= most_moves")
        fresh = faults.where("bad").select("host", F.col("class").alias("name")).union(restless.select("host", "role"))
        several, split = measured(said.where("slot <> other_slot").join(faults.where("bad OR most_moves > 0").select("host").distinct(), "host", "left_anti").groupBy("host").agg(F.collect_list("role").alias("several")))
        slots = said.where("slot = other_slot").select("host", "role", "slot")
        fresh, objections = measured(fresh)
        if not objections and not split:
            break
        banned = cut_lineage(banned.union(fresh))
        if split:
            tokens = cut_lineage(on_pages.join(broadcast_if_small(several, split), "host", "left").mapInPandas(_split, PAGE_TOKENS).union(tokens.join(broadcast_if_small(members, n), "host", "left_anti")))
            vectors = _vectors(tokens, sizes)
    good = said.where("class <> 0").join(faults.where("NOT bad AND most_moves = 0"), ["host", "class"], "left_semi").where("slot = other_slot").select("host", "role")
    valid = vectors.join(good, ["host", "role"], "left_semi")
    only = F.when(F.col("role") == F.col("base"), -1).when((F.col("nth") == F.col("last_nth")) & (F.col("most") == 1), F.col("nth")).cast("long")
    kind = F.col("base").bitwiseAND(F.lit(3))
    slot = (kind == OPEN) & (F.col("most") == 1) & (F.col("chars") > 0) & only.isNotNull()
    own = F.struct("base", only.alias("nth"), (F.col("links") / F.col("chars") >= 0.5).alias("linked"))
    opened = valid.groupBy("host").agg(F.collect_set(F.when(slot, own)).alias("slots"))
    parts = valid.where(kind == TEXT).groupBy("host", "base").agg(F.sum("total").alias("total"), F.collect_set(only).alias("nth"))
    parts = parts.join(names.select("host", "base", F.col("total").alias("in_all")), ["host", "base"])
    parts = parts.withColumn("nth", F.explode(F.when(F.col("total") == F.col("in_all"), F.array(F.lit(-1).cast("long"))).otherwise(F.col("nth"))))
    return opened.join(parts.groupBy("host").agg(F.collect_set(F.struct("base", "nth")).alias("fixed")), "host", "left")


def _supported(tokens: DataFrame, wanted: DataFrame) -> DataFrame:
    """The pages of hosts that have tokens on enough pages, with these tokens only."""
    wanted, n = measured(wanted)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = [[role in kept for role in roles] for roles, kept in zip(frame["role"], map(set, frame["wanted"]))]
            yield pd.DataFrame({"host": frame["host"], "key": frame["key"]} | {c: [[x for x, k in zip(xs, ks) if k] for xs, ks in zip(frame[c], keep)] for c in ("base", "role", "chars", "links")})

    return cut_lineage(tokens.join(broadcast_if_small(wanted, n), "host").mapInPandas(cut, PAGE_TOKENS))


def main_text(source: str, slots: dict[tuple[int, int], bool], fixed: frozenset[tuple[int, int]] | set[tuple[int, int]]) -> str:
    """Text of a page's open slots: all that is neither frame, nor repeated by the host's template, nor in a slot of links.

    Where the page marks its article, the marks settle which of the open slots are the article's: an ``article``, or what is
    around it in ``main`` if more text stands there; several articles beside more text that is in none are teasers and mark nothing.
    There repeated texts stay: an article may repeat itself from page to page.
    """
    page = read_page(source)
    elements = page.elements
    texts = [t for t in page.texts if not elements[t[0]].side]
    sizes, articles = Counter(), sum(e.tag == "article" and elements[e.parent].main < 3 and not e.side for e in elements)
    for at, text, _ in texts:
        if not elements[at].link:
            sizes[elements[at].main] += len(text) - text.count(" ") if not text.isspace() else 0
    level = max((elements[t[0]].main for t in texts), default=0)
    if level == 3 and articles > 1 and sizes.total() - sizes[3] > sizes[3]:
        level = 0 if sizes[0] >= sizes[2] + sizes[1] else 2 if sizes[2] else 1
    elif level == 3 and sizes[2] > sizes[3]:
        level = 2
    if level:
        texts = [t for t in texts if elements[t[0]].main >= level]
    else:
        linked, repeated = _linked(elements, slots), _repeated(elements, texts, fixed)
        texts = [t for t, again in zip(texts, repeated) if not again and not linked[t[0]] and (elements[t[0]].main < 3 or articles <= 1)]
    parts, last = [], -1
    for _, text, block in texts:
        if block != last:
            parts.append(" ")
        parts.append(html.unescape(text))
        last = block
    return " ".join("".join(parts).split())


def _linked(elements: list[Element], slots: dict[tuple[int, int], bool]) -> list[bool]:
    """Whether the innermost slot around an element is one of links."""
    out, seen = [False] * len(elements), Counter()
    for at, element in enumerate(elements):
        out[at] = out[element.parent] if at else False
        if slots and at and not element.side:
            name = _opened(element)
            out[at] = slots.get((name, -1), slots.get((name, seen[name]), out[at]))
            seen[name] += 1
    return out


def _repeated(elements: list[Element], texts: list[tuple[int, str, int]], fixed: frozenset[tuple[int, int]] | set[tuple[int, int]]) -> list[bool]:
    """Whether a text is one of the template's."""
    out, seen = [False] * len(texts), Counter()
    for number, (at, text, _) in enumerate(texts if fixed else ()):
        if not text.isspace():
            name = _text_token(elements[at], _plain(text))
            out[number] = (name, -1) in fixed or (name, seen[name]) in fixed
            seen[name] += 1
    return out


def extract_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``row``, ``text`` (empty if none).

    Templates are small, one row per host, and join the pages by broadcast up to a measured size.

    Null html or url: no page, no host (one group of their own).  A page that is alone on its host, or unlike its
    host's template, is read by its own marks alone.  Repeated rows get the same text; in the occurrence vectors they count
    alike for all tokens.  Empty table: no rows.  Other columns travel in ``row``.
    """
    host = F.lower(F.regexp_extract(text_of(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(whole_row(pages), host.alias("host"), text_of(html_col).alias("html"))
    templates, n = measured(deduce_templates(rows.select("host", F.xxhash64("html", F.col(f"row.{quoted(url_col)}")).alias("key"), "html")))
    rows = rows.join(broadcast_if_small(templates, n), "host", "left")

    @F.pandas_udf("string")
    def extract(sources: pd.Series, slots: pd.Series, fixed: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, {(x["base"], x["nth"]): x["linked"] for x in s} if s is not None else {}, {(x["base"], x["nth"]) for x in f} if f is not None else set()) for h, s, f in zip(sources, slots, fixed)], dtype="object")

    return rows.select("row", extract("html", "slots", "fixed").alias("text"))
