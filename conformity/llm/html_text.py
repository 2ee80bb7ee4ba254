"""Main text of web pages by site style trees.

The DOMs of one host are merged into a tree whose nodes are element paths (tag with its class and id,
digits dropped). Pages of equal main content count once, whatever stands around it. All elements that can hold
text are nodes, menus and footers like articles. For each node the tree holds

* its presentation: the sequences of child elements seen, whose entropy over the host's pages is the
  node's presentation importance (one style on all pages: 0);
* its content: each distinct block of text, whose entropy over the pages that have the node is 0 if it is
  on one page and 1 if it is on all; the content importance is 1 less the mean over distinct blocks;
* the share of its text that is link text;
* whether its element is marked: HTML states that it is no article text (``nav``, ``aside``, ``footer``, ``form``,
  ``role=`` and so on, a ``header`` outside an article), or its class or id has a word that says so. Inside
  ``main`` and ``article`` words count only if one that names an advert, comments, sharing or a notice is a whole class.

A branch's importance is the style-weighted mean of its own presentation importance and the content
importance below it, less its link share, and times ``MARKED`` for marked elements, unless these hold nearly all
of the host's text (``WRAPPER``): a wrapper round the article is no sidebar, whatever it is called. Branches of
low importance are removed from every page of the host, but never ``html``, ``body``, ``main`` or ``article`` itself.
Elements whose content is never shown as text (scripts, styles, controls, hidden elements) are left out.

A null or empty html gives an empty text; a page without a host (null url too) shares a tree with others
without one. A few pages say little about a host: its branches' importance is drawn towards that of their
paths on all hosts (``PRIOR_PAGES``; 1 where no host has the path on two pages). Elements nested deeper than
``DEPTH`` belong to the branch of their ancestor there. Repeated rows are extracted each. An empty table gives no rows. White space is what ``str.split`` splits at.
"""

from __future__ import annotations

import bisect
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, prepare, saved

#: A branch of a host is judged as if so many pages with the corpus's importance of its path were added.
PRIOR_PAGES = 4
#: Elements nested deeper belong to the branch of their ancestor at this depth.
DEPTH = 64
IMPORTANCE = 0.3
GAMMA = 0.9
#: Low-importance paths are sent to every task up to this many bytes; beyond it they are joined by salted host.
BROADCAST_BYTES = 8 << 20
SALTS = 32

#: Paths of elements that are never removed whole.
KEPT_TAGS = r">(html|body|main|article)(\.[^>]*)?$"

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no text of a page, and those that HTML says are beside it.
NO_TEXT = frozenset("head script style noscript template svg iframe textarea select button object canvas audio video title option datalist map".split())
STATED = frozenset("nav footer aside form menu dialog".split())
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
ROLE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie cookies "
    "discussion disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification outbrain "
    "pagination pager popup promo promoted promotion recommended related replies reply respond share sharing shares sidebar sidenav "
    "signup skip social sponsor sponsored sponsors subscribe taboola tags toc toolbar topbar widget widgets".split()
)
#: Words that mark an element inside an article too, if one is a class of its own.
INNER_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsored comment comments replies share sharing newsletter cookie cookies notice".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

#: Elements whose content is no markup.
RAW = frozenset("script style noscript template svg iframe textarea".split())
NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
STOPS = re.compile(r"['\">]")
#: A tag without ``<`` inside, which an attempt never reads beyond.
PLAIN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"<]*\"|'[^'<]*'|[^'\"<>])*)>")
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)
WORD = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Importance of a marked element as a part of what its text and style say, and the share of a host's text
#: above which its mark counts for nothing. The step of a marked element ends with ``MARK``.
MARKED, WRAPPER, MARK = 0.25, 0.8, "!"
_seen: dict[tuple[str, str], tuple[str, bool, bool, bool]] = {}


def _look(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """Signature of an element, whether it holds no text, and whether it is marked outside and inside an article."""
    key = (tag, attributes)
    found = _seen.get(key)
    if found is None:
        sign, empty, stated, outer, inner = tag, tag in NO_TEXT, tag in STATED, False, False
        if attributes:
            for name, a, b, c in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), a or b or c
                if name in ("class", "id"):
                    sign += "." + DIGITS.sub("", value).replace(">", "")
                    outer = outer or not ROLE_WORDS.isdisjoint(WORD.findall(CAMEL.sub(" ", value).lower()))
                    inner = inner or not INNER_WORDS.isdisjoint(value.lower().split())
                elif name == "role":
                    stated = stated or value.lower() in ROLES
                elif name == "hidden" or value.lower() == "true":
                    empty = True
            if tag in ("html", "body", "main", "article"):
                empty = stated = outer = inner = False
        if len(_seen) > 50_000:
            _seen.clear()
        found = _seen[key] = (sign.rstrip(MARK), empty, stated or outer or tag == "header", stated or inner)
    return found


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, tag, attributes) of the markup of a page; comments, declarations and the content of
    raw elements have no tag. A tag ends at the first ``>`` outside quotes. The time is linear in the page:
    what has failed to end once is not scanned again."""
    stops: list[int] | None = None
    dead: set[int] = set()
    never: set[str] = set()
    at = page.find("<")
    while at >= 0:
        end, slash, tag, attributes = -1, "", "", ""
        m = PLAIN.match(page, at)
        if m:
            slash, tag, attributes, end = m[1], m[2].lower(), m[3], m.end()
        elif m := NAME.match(page, at + 1):
            slash, tag = m[1], m[2].lower()
            stops = [x.start() for x in STOPS.finditer(page)] if stops is None else stops
            k, passed = bisect.bisect_left(stops, m.end()), []
            while k < len(stops) and k not in dead:
                passed.append(k)
                if page[stops[k]] == ">":
                    end = stops[k] + 1
                    break
                closing = page.find(page[stops[k]], stops[k] + 1)
                k = bisect.bisect_right(stops, closing) if closing >= 0 else len(stops)
            if end < 0:
                dead.update(passed)
            attributes = page[m.end() : end - 1] if end >= 0 else ""
        elif page.startswith("<!--", at):
            closing = page.find("-->", at + 4)
            end = closing + 3 if closing >= 0 else len(page)
        elif page.startswith(("<!", "<?"), at) and ">" not in never:
            end = page.find(">", at) + 1
            if not end:
                never.add(">")
                end = -1
        if end >= 0:
            if tag in RAW and not slash and tag not in never:
                closing_tag = RAW_END[tag].search(page, end)
                if closing_tag:
                    end, tag = closing_tag.end(), ""
                else:
                    never.add(tag)
            yield at, end, slash, tag, attributes
        at = page.find("<", max(end, at + 1))


RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}


def blocks(page: str) -> tuple[list[tuple[str, str, int, int]], list[tuple[str, str]]]:
    """Blocks of text as (path, text, characters, link characters), in page order,
    and the presentation (path, sequence of child signatures) of the elements that hold them."""
    out: list[tuple[str, str, int, int]] = []
    styles: list[tuple[str, str]] = []
    # element: [tag, path, dropped, child signatures]
    stack: list[list] = [["", "", False, []]]
    open_tags: Counter[str] = Counter()
    buffer: list[str] = []
    links, linked, at = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            if text:
                out.append((stack[-1][1], text, len(text), min(linked, len(text))))
            buffer.clear()
        linked = 0

    def pop() -> None:
        tag, path, dropped, children = stack.pop()
        open_tags[tag] -= 1
        if not dropped and children:
            styles.append((path, " ".join(children)))

    for start, end, slash, tag, attributes in tags(page):
        if start > at and not stack[-1][2]:
            text = page[at:start]
            buffer.append(text)
            if links:
                linked += len(text)
        at = end
        if not tag:
            continue
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if slash else 1
            continue
        if tag == "br":
            if not stack[-1][2]:
                buffer.append(" ")
            continue
        flush()
        links = 0
        if slash:
            while open_tags[tag] and stack[-1][0] != tag:
                pop()
            if open_tags[tag]:
                pop()
            continue
        if tag in VOID or attributes.endswith("/"):
            continue
        if tag == "body":
            while len(stack) > 1 and stack[-1][0] != "html":
                pop()
        elif stack[-1][0] in CLOSED_BY_BLOCK:
            pop()
        closes = SELF_CLOSING.get(tag)
        if closes and any(open_tags[c] for c in closes):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in closes:
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table"):
                    break
        sign, empty, outer, inner = _look(tag, attributes)
        if inner if open_tags["article"] or open_tags["main"] else outer:
            sign += MARK
        parent = stack[-1]
        if not parent[2]:
            parent[3].append(sign)
        stack.append([tag, f"{parent[1]}>{sign}" if len(stack) <= DEPTH else parent[1], parent[2] or empty, []])
        open_tags[tag] += 1
    if at < len(page) and not stack[-1][2]:
        buffer.append(page[at:])
    flush()
    while len(stack) > 1:
        pop()
    return out, styles


def _removed(path: str, low: frozenset[str], kept: frozenset[str]) -> bool:
    """Whether a path or one above it is low: as listed, or marked and not listed as kept."""
    while path:
        if path in low or path.endswith(MARK) and path not in kept:
            return True
        path = path[: max(path.rfind(">"), 0)]
    return False


def main_text(page: str | None, low: frozenset[str] = frozenset(), kept: frozenset[str] = frozenset()) -> str:
    """Text of the blocks outside low-importance branches, joined by one space."""
    if not page:
        return ""
    known: dict[str, bool] = {}
    out = []
    for path, text, *_ in blocks(page)[0]:
        if path not in known:
            known[path] = _removed(path, low, kept)
        if not known[path]:
            out.append(text)
    return " ".join(out)


def content_digest(found: list[tuple[str, str, int, int]]) -> int:
    """Digest of a page's main content: of the blocks in ``main`` or ``article``, or of those that are not mostly
    links, without those below marked elements."""
    found = [b for b in found if f"{MARK}>" not in b[0] and not b[0].endswith(MARK)] or found
    kept = [b for b in found if any(step.split(".", 1)[0] in ("main", "article") for step in b[0].split(">"))]
    kept = kept or [b for b in found if 2 * b[3] <= b[2]] or found
    return _hash("\n".join(b[1] for b in kept))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.select("page_id", "url", host.alias("host"), F.col("html").cast("string").alias("html"))


def tree_features(pages: DataFrame) -> DataFrame:
    """host, page (digest), kind (0 content, 1 presentation), path, feature, chars, link_chars of each page's nodes."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = tuple([] for _ in range(7))
            for host, page in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                found, styles = blocks(page)
                digest = content_digest(found)
                rows = {(0, path, _hash(text)): (n, k) for path, text, n, k in found}
                rows |= {(1, path, _hash(style)): (0, 0) for path, style in styles}
                for (kind, path, feature), (n, k) in rows.items():
                    for column, value in zip(out, (host, digest, kind, path, feature, n, k), strict=True):
                        column.append(value)
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    names = ["host", "page", "kind", "path", "feature", "chars", "link_chars"]
    narrow = pages.where(F.length("html") > 0).select("host", "html")
    return narrow.mapInArrow(parse, "host string, page long, kind int, path string, feature long, chars long, link_chars long")


def branch_importance(features: DataFrame) -> DataFrame:
    """host, path, pages and importance of every node of the hosts' trees."""
    once = features.groupBy("host", "kind", "path", "feature", "page").agg(F.max("chars").alias("chars"), F.max("link_chars").alias("link_chars"))
    spread = once.groupBy("host", "kind", "path", "feature").agg(F.count(F.lit(1)).alias("c"), F.sum("chars").alias("chars"), F.sum("link_chars").alias("link_chars"))
    held = features.groupBy("host", "kind", "path", "page").agg(F.lit(1).alias("one")).groupBy("host", "kind", "path").agg(F.count(F.lit(1)).alias("m"))
    nodes = (
        spread.groupBy("host", "kind", "path")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.log("c")).alias("logs"),
            F.sum(F.col("c") * F.log("c")).alias("c_logs"),
            F.sum("chars").alias("chars"),
            F.sum("link_chars").alias("link_chars"),
        )
        .join(held, ["host", "kind", "path"])
    )
    alone = F.col("m") <= 1
    log_m = F.log(F.greatest(F.col("m"), F.lit(2)))
    content = F.when(alone, 1.0).otherwise(1 - F.col("logs") / F.col("n") / log_m)
    style = F.when(alone, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - F.col("c_logs") / F.col("m") / log_m))
    leaves = nodes.where("kind = 0").withColumn("own", content)
    steps = F.split("path", ">")
    above = F.transform(F.sequence(F.lit(2), F.size(steps)), lambda k: F.concat_ws(">", F.slice(steps, 1, k)))
    # a node's share in a branch is the number of distinct blocks it has seen
    branches = (
        leaves.where(F.size(steps) >= 2).select("host", F.explode(above).alias("path"), "own", "n", "m", "chars", "link_chars")
        .groupBy("host", "path")
        .agg(
            (F.sum(F.col("own") * F.col("n")) / F.sum("n")).alias("below"),
            F.max("m").alias("pages"),
            (F.sum("link_chars") / F.greatest(F.sum("chars"), F.lit(1))).alias("link_share"),
            F.sum("chars").alias("chars"),
        )
        .join(leaves.groupBy("host").agg(F.sum("chars").alias("all_chars")), "host")
    )
    mark = F.when(F.col("path").endswith(MARK) & (F.col("chars") <= WRAPPER * F.col("all_chars")), MARKED).otherwise(1.0)
    styles = nodes.where("kind = 1").select("host", "path", style.alias("style"))
    scored = branches.join(styles, ["host", "path"], "left")
    weighed = F.when(F.col("style").isNull(), F.col("below")).otherwise((1 - GAMMA) * F.col("style") + GAMMA * F.col("below"))
    own = saved(scored.select("host", "path", "pages", (weighed * (1 - F.col("link_share"))).alias("own"), mark.alias("mark")), "branch-scores")
    # one page of a host is no evidence: m pages count as m - 1
    seen = F.col("pages") - 1
    corpus = own.groupBy("path").agg(((F.sum(seen * F.col("own")) + 1) / (F.sum(seen) + 1)).alias("prior"))
    drawn = (seen * F.col("own") + PRIOR_PAGES * F.col("prior")) / (seen + PRIOR_PAGES)
    return own.join(corpus, "path").select("host", "path", "pages", (drawn * F.col("mark")).alias("importance"))


def low_branches(pages: DataFrame, threshold: float = IMPORTANCE) -> DataFrame:
    """host, the array of its unmarked paths of low importance and that of its marked paths of more.

    Marked paths are low unless listed, so that what hosts have in common is in no list.
    """
    # read by several aggregations: pages are parsed once for all of them
    features = saved(tree_features(pages), "tree-features")
    marked = F.col("path").endswith(MARK)
    scored = branch_importance(features).withColumn("is_low", F.col("importance") < threshold).where((F.col("is_low") != marked) & ~F.col("path").rlike(KEPT_TAGS))
    paths = lambda which: F.array_sort(F.collect_set(F.when(which, F.col("path"))))
    return scored.groupBy("host").agg(paths(~marked).alias("low"), paths(marked).alias("kept"))


def extract_main_text(pages: DataFrame, threshold: float = IMPORTANCE) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    prepare(pages.sparkSession)
    hosted = with_host(pages)
    low = saved(low_branches(hosted, threshold), "low-branches")
    held = low.agg(F.sum(F.length("host") + F.length(F.array_join(F.concat("low", "kept"), " "))).alias("n")).first()["n"] or 0
    if held <= BROADCAST_BYTES:
        joined = hosted.join(F.broadcast(low), "host", "left")
    else:  # a hot host's pages meet its paths in many tasks
        salted = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = hosted.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        joined = dealt.join(salted, ["host", "salt"], "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("html", _seen.clear)
        sets: dict[tuple, frozenset] = {}

        def held(paths: list[str] | None) -> frozenset[str]:
            key = tuple(paths or ())
            if key not in sets:
                if len(sets) > 1000:
                    sets.clear()
                sets[key] = frozenset(key)
            return sets[key]

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (2, 3, 4)]
            texts = [main_text(page, held(low), held(kept)) for page, low, kept in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    narrow = joined.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html", "low", "kept")
    return narrow.mapInArrow(extract, "page_id long, url string, text string, n_chars long")


def op7_html_text(spark, sf_dir: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
