"""Main text of web pages by differencing each page against the page of the nearest URL on its host.

A page becomes lines, one per block. Pages are put in order of host and path, and each is paired with the neighbour
whose path shares the longer beginning. Lines of both are aligned by a longest common subsequence, and lines that both
have are taken for the site's frame and deleted. Markup that says what it is goes first: an article element's lines are
text even where the neighbour has them too (articles are republished under neighbouring paths), and menus, adverts,
forms and the like are not, even where they differ from page to page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlake.llm.common import arrow_pass
from cohortlake.sources.workspace import materialise

OPEN, TEXT, FRAME = 0, 1, 2
#: A tag ends at the first ``>`` outside a quoted attribute value.
TOKENS = re.compile(r"""<!--.*?(?:-->|\Z)|<[a-zA-Z/!?](?:[^>=]+|=\s*(?:"[^"]*"|'[^']*')?)*(?:>|\Z)|[^<]+|<""", re.S)
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: Elements whose content is not text of the page.
RAW = frozenset("script style template noscript iframe svg math textarea select canvas object".split())
#: Of these, those whose content has no tags: it runs to the element's literal end tag.
RAW_TEXT = frozenset("script style noscript iframe textarea title".split())
MAIN = frozenset(("article", "main"))
FRAMES = frozenset(("nav", "footer", "aside", "form", "menu", "dialog", "button", "head", "title"))
#: Elements that may be found open again when they end; paragraphs and inline elements need no place in the tree.
TREE = RAW | MAIN | FRAMES | frozenset("header div section ul ol dl table figure body html".split())
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr br".split())
#: Elements whose end tag may be left out, by the elements whose start ends them, and those beyond which they stay open.
CLOSES = {
    "p": frozenset(("p",)), "li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p")),
    "tr": frozenset(("tr", "td", "th", "p")), "td": frozenset(("td", "th", "p")), "th": frozenset(("td", "th", "p")),
}
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section table ul".split()
)
P_SCOPE = frozenset("table caption td th button object".split())
SCOPES = {"li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)), "tr": frozenset(("table",)), "td": frozenset(("table", "tr")), "th": frozenset(("table", "tr"))}
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Whole names in class, id and role that say that an element belongs to the frame.
FRAME_WORDS = re.compile(
    r"""ads?|adverts?|advertisement|sponsor(?:ed)?|promo|banner|cookies?|consent|notice|newsletter|subscribe|
    comments?|disqus|share|social|sidebar|breadcrumbs?|menu|navigation|navbar|related|popup|modal|footer""", re.X | re.I
)
#: Words that make a hyphenated name one of the frame's if they begin or end it.
FRAME_ENDS = re.compile(r"ads?|adverts?|advertisement|sponsor(?:ed)?|cookies?|consent|newsletter|comments?|disqus|sidebar|breadcrumbs?|navbar|popup|modal", re.I)
#: Words that say so only beside one for a part of a page, as in ``share-buttons``; ``share-price`` is no frame.
FRAME_HALVES = re.compile(r"share|social|related|promo|banner|menu|navigation|subscribe|footer|notice", re.I)
PLACES = re.compile(r"bar|box|list|links?|buttons?|block|widget|area|section|wrap|wrapper|container|posts?|articles?|icons?|panel|slot|left|right|top|bottom|main|site|page", re.I)
#: Parts by which a name tells how a page is laid out, as in ``no-sidebar``.
LAYOUT = frozenset("no not has with without is".split())
#: Elements that hold a page's text whatever they are called.
NEVER_NAMED = frozenset("html body main article".split())
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')""")
HIDDEN = re.compile(r"\shidden(?=[\s>=/])", re.I)
NOT_SHOWN = re.compile(r"""\bstyle\s*=\s*(?:"[^"]*display\s*:\s*none|'[^']*display\s*:\s*none|display:none)""", re.I)


def frame_name(name: str) -> bool:
    """Whether a class, id or role is one of the frame's: a frame word, or parts of which an outer one is."""
    if FRAME_WORDS.fullmatch(name):
        return True
    parts = re.split(r"[-_]+", name.lower().strip("-_"))
    if len(parts) == 1 or not LAYOUT.isdisjoint(parts):
        return False
    if FRAME_ENDS.fullmatch(parts[0]) or FRAME_ENDS.fullmatch(parts[-1]):
        return True
    return all(FRAME_HALVES.fullmatch(p) or PLACES.fullmatch(p) for p in parts) and any(FRAME_HALVES.fullmatch(p) for p in parts)


def named_frame(token: str, is_frame: Callable[[str], bool] = frame_name) -> bool:
    """Whether a name in the tag's class, id or role is one of the frame's."""
    return any(is_frame(name) for value in NAMED.findall(token) for name in value.strip("\"'").split())


def hidden(token: str) -> bool:
    """Whether the tag has the attribute ``hidden`` or a style that shows nothing."""
    return bool(NOT_SHOWN.search(token) or HIDDEN.search(QUOTED.sub("=", token)))


def lines_of(page: str | None) -> tuple[list[str], list[int]]:
    """A page's lines, white space joined and trimmed, and the zone of each: open, text or frame."""
    lines: list[str] = []
    zones: list[int] = []
    stack: list[tuple[str, int]] = []
    zone, skip, parts = OPEN, "", []
    mute, depth, blocks = "", 0, 0  # an inline element that is not shown, how often it is open in itself, blocks begun inside

    def end_line() -> None:
        line = " ".join("".join(parts).split())
        parts.clear()
        if line:
            lines.append(line)
            zones.append(zone)

    def close(names: frozenset[str], scope: frozenset[str]) -> None:
        """Ends the outermost open element of ``names`` that is inside the nearest of ``scope``."""
        nonlocal zone
        at = None
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in scope:
                break
            if stack[k][0] in names:
                at = k
        if at is not None:
            zone = stack[at][1]
            del stack[at:]

    page, place = page or "", 0
    while place < len(page):
        token = TOKENS.match(page, place)[0]
        place += len(token)
        if token[0] != "<" or len(token) == 1:
            if not skip and not mute:
                parts.append(html.unescape(token))
            continue
        found = TAG.match(token)
        if not found:
            continue  # a comment or a declaration
        ending, name = found[1] == "/", found[2].lower()
        if not ending and name in RAW_TEXT and not token.endswith("/>"):
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, place)
            raw, place = page[place : (end.start() if end else len(page))], end.start() if end else len(page)
        else:
            raw = ""
        if skip:
            if ending and name == skip:
                skip = ""
            continue
        if name in INLINE:
            if name == "br" or name == "wbr":
                parts.append(" " if name == "br" and not mute else "")
            elif name == mute:
                depth += -1 if ending else 1
                mute = mute if depth else ""
            elif not mute and not ending and name != "img" and not token.endswith("/>") and (hidden(token) or named_frame(token, FRAME_ENDS.fullmatch)):
                mute, depth, blocks = name, 1, 0
            continue
        if mute and name not in VOID:
            blocks += -1 if ending else 1
            mute = mute if blocks >= 0 else ""  # the block around it ends, and so does what was left open in it
        end_line()
        if name in VOID or token.endswith("/>"):
            continue
        if ending:
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if at is not None:
                zone = stack[at][1]
                del stack[at:]
            elif name in ENDS_P or name in CLOSES:
                close(CLOSES["p"], P_SCOPE)
            continue
        if name in RAW:
            skip = name
            continue
        if name in ENDS_P:
            close(CLOSES["p"], P_SCOPE)
        if name in SCOPES:
            close(CLOSES[name], SCOPES[name])
        if name in TREE:
            stack.append((name, zone))
            if zone != FRAME:
                if name in FRAMES or name == "header" and zone == OPEN or name not in NEVER_NAMED and named_frame(token) or hidden(token):
                    zone = FRAME
                elif name in MAIN:
                    zone = TEXT
            parts.append("" if mute else html.unescape(raw))
        elif zone == FRAME or named_frame(token) or hidden(token):
            stack.append((name, zone))
            zone = FRAME
    end_line()
    return lines, zones


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Indexes in ``a`` of one longest common subsequence with ``b``, by bit-parallel rows and a walk back."""
    head = 0
    while head < len(a) and head < len(b) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < len(a) - head and tail < len(b) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    places: dict[int, int] = {}
    for j, v in enumerate(y):
        places[v] = places.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1
    rows = [full]
    for v in x:
        row, hit = rows[-1], rows[-1] & places.get(v, 0)
        rows.append(((row + hit) | (row - hit)) & full)
    i, j, found = len(x), len(y), []
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif rows[i - 1] >> (j - 1) & 1:
            i, j = i - 1, j - 1
            found.append(head + i)
        else:
            i -= 1
    return [*range(head), *reversed(found), *range(len(a) - tail, len(a))]


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def neighbours(keys: DataFrame) -> DataFrame:
    """``page, key, other_page, other_key``: the page next in order of host and path, the nearer of the two.

    Rows are range-partitioned by host, path and page, so a hot host is many tasks; a partition's first and last row find
    their neighbours in one row per partition.
    """
    place = ["host", "path", "page", "key"]
    placed = keys.select(*place).repartitionByRange(*place).select(*place, F.spark_partition_id().alias("part"))
    placed = materialise(placed, "places")
    row, within = F.struct(*place), W.partitionBy("part").orderBy(*place)
    edges = placed.groupBy("part").agg(F.min(row).alias("low"), F.max(row).alias("high"))
    parts = W.orderBy("part")
    edges = edges.select("part", F.lag("high").over(parts).alias("before_part"), F.lead("low").over(parts).alias("after_part"))
    both = placed.join(edges, "part").select(
        *place, F.coalesce(F.lag(row).over(within), "before_part").alias("before"), F.coalesce(F.lead(row).over(within), "after_part").alias("after")
    )

    def shared(other: str) -> Column:
        alike = F.expr(f"aggregate(sequence(1, greatest(least(length(path), length({other}.path)), 1)), 0, (n, i) -> "
                       f"CASE WHEN n = i - 1 AND substr(path, i, 1) = substr({other}.path, i, 1) THEN i ELSE n END)")
        return F.when(F.col(f"{other}.host") == F.col("host"), alike).otherwise(-1)

    scored = both.withColumn("s_before", F.coalesce(shared("before"), F.lit(-1))).withColumn("s_after", F.coalesce(shared("after"), F.lit(-1)))
    nearest = F.when((F.col("s_before") >= F.col("s_after")), F.col("before")).otherwise(F.col("after"))
    return (
        scored.where("host != '' AND greatest(s_before, s_after) >= 0")
        .select("page", "key", nearest.alias("other"))
        .select("page", "key", F.col("other.page").alias("other_page"), F.col("other.key").alias("other_key"))
    )


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars, n_shared`` per row: the page's main text, its length, and how many lines its neighbour shares.

    Text of an article (or main) element is kept, less frames inside it. A page without one keeps the lines that
    neither markup nor the neighbour tells to be frame. Lines are joined by a line feed; character references are decoded and white
    space inside a line is one space.

    Null and empty html give an empty text. A page with no neighbour on its host, a null url or one without a host is judged by markup
    alone. Repeated rows are one page to the neighbours and all come back; null ids too. An empty table gives an empty one; other
    columns are ignored.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    source = pages.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("page"), F.xxhash64(url_col, html_col).alias("key"),
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"),
        F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"://[^/?#]*([^?#]*)", 1).alias("path"),
    )

    # Pages are parsed twice: lines' hashes are stored for the neighbours, and texts go straight to the join. Storing both would
    # take a copy of all texts beside the one that is shuffled.
    def hash_lines(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            found = (lines_of(t.as_py())[0] for t in b["html"])
            hashed = [[xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63) for x in lines] for lines in found]
            yield {**{c: b[c] for c in ("page", "key", "host", "path")}, "lines": hashed}

    def wanted_lines(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            wanted, places = [], []
            for t in b["html"]:
                lines, zones = lines_of(t.as_py())
                best = TEXT if TEXT in zones else OPEN
                wanted.append([x for x, z in zip(lines, zones) if z == best])
                # lines of an article stay whatever the neighbour has, so they need no place
                places.append([i for i, z in enumerate(zones) if z == OPEN] if best == OPEN else None)
            yield {**{c: b[c] for c in ("id", "url", "page", "key")}, "wanted": wanted, "places": places}

    hashing = arrow_pass(source.drop("id", "url"), hash_lines, "page string, key long, host string, path string, lines array<bigint>")
    parsed = materialise(hashing, "lines")
    hashed = parsed.select("page", "key", "lines").dropDuplicates(["page", "key"])
    pairs = neighbours(parsed.select("page", "key", "host", "path").distinct())
    other = hashed.select(F.col("page").alias("other_page"), F.col("key").alias("other_key"), F.col("lines").alias("other_lines"))
    both = hashed.join(pairs, ["page", "key"]).join(other, ["other_page", "other_key"]).select("page", "key", "lines", "other_lines")

    def align(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            shared = [common_lines(x, y) for x, y in zip(b["lines"].to_pylist(), b["other_lines"].to_pylist())]
            yield {"page": b["page"], "key": b["key"], "shared": shared}

    aligned = arrow_pass(both, align, "page string, key long, shared array<int>")
    ddl = f"id {kind}, url string, page string, key long, wanted array<string>, places array<int>"
    joined = arrow_pass(source.drop("host", "path"), wanted_lines, ddl).join(aligned, ["page", "key"], "left")
    shared = F.coalesce("shared", F.array().cast("array<int>"))
    left = F.filter(F.arrays_zip("wanted", "places"), lambda x: ~F.array_contains(shared, x["places"]))
    text = F.array_join(F.when(F.col("places").isNull(), F.col("wanted")).otherwise(F.transform(left, lambda x: x["wanted"])), "\n")
    out = joined.select(F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text"), F.size(shared).alias("n_shared"))
    return out.select(id_col, url_col, "text", F.length("text").cast("long").alias("n_chars"), "n_shared")
