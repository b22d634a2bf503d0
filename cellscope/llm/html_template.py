"""HTML extraction by template deduction from token equivalence classes.

Every page is read as a sequence of tokens: the opening tag of each element, named by its path and class, and each
text segment. Tokens of pages of one host with the same occurrence vector (how often each page holds the token) form
an equivalence class; the vector is never gathered, only its fingerprint: a sum over pages of hash(page) * count, so
a host of any size is a partial aggregation. The class of tokens that occur exactly once on every page is the outer
template; a class whose tokens all lie inside one slot of it (a menu's items, say) nests in that slot. Of the
template's containers the main region is the deepest that still holds most of the host's readable text. The rest of
the template (tags, constant text segments, boilerplate containers) is dropped, and the region's slots are the text.

Hosts with fewer than MIN_PAGES different pages cannot show a template of their own; they share one deduced over all
such hosts, from tags only. A constant text counts as template only on hosts with at least MIN_TEXT_PAGES pages, on
all of which it stands as often as some element does.

Defined cases: null or empty html gives an empty text; a null or odd url has the empty host; repeated rows each give
a row, and equal pages of a host count as one page where its number of pages is judged; unclosed, misnested or cut markup is read as far as it
goes; character references are decoded once; white space in a block becomes one space; extra columns are ignored.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellscope.llm.common import stored

MIN_PAGES = 4
MIN_TEXT_PAGES = 12
#: A container is the main region only if it holds this share of its host's readable text.
SHARE = 0.5

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|select|iframe|svg)\b.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<", re.S | re.I)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

# How elements behave in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
CONTAINER = frozenset("html body main article section div td th table tbody tr center blockquote".split())
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
CLOSED_BY_BLOCK = {"p"}
# Elements, classes and roles that are never article text.
BOILERPLATE_TAGS = frozenset("head nav header footer aside form menu button dialog title".split())
BOILERPLATE_NAMES = re.compile(r"(?:^|[^a-z])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notice|popup|modal|newsletter|subscribe|menu|nav\w*|breadcrumbs?|sidebar|header|footer|"
                               r"comments?|comment-list|disqus|replies|respond|share|sharing|social|related|recommend\w*|pagination|pager|widget|skip-link|copyright|legal|disclaimer)(?:$|[^a-z])", re.I)


def host():
    """The lower-cased host of column ``url``, empty for a null or odd one."""
    found = F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found).alias("host")


def segments(page: str | None):
    """Yield (path, is boilerplate, text, flag) of a page: a text with its element's path and whether it is in a link;
    no text where a block element opens (flag set, its own path) or closes (flag not set, the path left).

    A path names the open block elements with their classes; inline elements leave it as it is.
    """
    stack: list[tuple[str, str, bool]] = []  # element, path, boilerplate
    link = 0
    for m in TOKEN.finditer(page or ""):
        token, close, tag = m[0], m[2], m[3]
        if tag is None:
            if token[0] != "<" or token == "<":
                path, bad = (stack[-1][1], stack[-1][2]) if stack else ("", False)
                yield path, bad, token, link > 0
            elif m[1]:
                yield (stack[-1][1] if stack else "") + "/" + m[1].lower(), True, None, True
            continue
        tag = tag.lower()
        if tag in INLINE:
            link = max(0, link + (0 if tag != "a" else -1 if close else 1))
            continue
        if tag == "br":
            path, bad = (stack[-1][1], stack[-1][2]) if stack else ("", False)
            yield path, bad, " ", False
            continue
        if close:
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if at is not None:
                del stack[at:]
            yield (stack[-1][1] if stack else ""), bool(stack and stack[-1][2]), None, False
            continue
        for gone in (CLOSES.get(tag) or CLOSED_BY_BLOCK):
            if stack and stack[-1][0] == gone:
                stack.pop()
        names = " ".join(x for g in NAMED.findall(m[4] or "") for x in g if x)
        bad = bool(stack and stack[-1][2]) or tag in BOILERPLATE_TAGS or (bool(names) and tag not in ("html", "body") and bool(BOILERPLATE_NAMES.search(names)))
        if tag == "body":
            stack = [s for s in stack if s[0] == "html"]
        path = (stack[-1][1] if stack else "") + "/" + tag + ("." + ".".join(sorted(set(names.lower().split()))) if names else "")
        yield path, bad, None, True
        if tag not in VOID and not (m[4] or "").endswith("/"):
            stack.append((tag, path, bad))
            if len(stack) > 200:
                del stack[100]


def blocks(page: str | None):
    """Yield (path, is boilerplate, text, link characters) of the page's blocks: texts between block boundaries, decoded."""
    parts, at, links = [], None, 0

    def block():
        text = " ".join(htmllib.unescape("".join(parts)).split())
        return (*at, text, links) if text else None

    for path, bad, text, link in segments(page):
        if text is None or at != (path, bad):
            if parts and (found := block()):
                yield found
            parts, links = [], 0
        if text is not None:
            at = (path, bad)
            parts.append(text)
            links += len(text.strip()) if link else 0
    if parts and (found := block()):
        yield found


def text_token(text: str) -> str:
    return "#" + xxhash.xxh3_128_hexdigest(text.encode("utf-8", "surrogatepass"))


def _container(path: str) -> bool:
    return path.rpartition("/")[2].partition(".")[0] in CONTAINER


def page_tokens(page: str) -> list[tuple[str, int, int, int]]:
    """(token, occurrences, first position, readable characters below it) of a page; elements by path, block texts by digest."""
    count: Counter = Counter()
    first: dict[str, int] = {}
    chars: Counter = Counter()
    for path, bad, text, opens in segments(page):
        if text is None and opens:
            first.setdefault(path, len(first))
            count[path] += 1
    for path, bad, text, links in blocks(page):
        token = text_token(text)
        first.setdefault(token, len(first))
        count[token] += 1
        while path and not bad:
            chars[path] += max(0, len(text) - links)
            path = path.rpartition("/")[0]
    return [(t, n, first[t], chars.get(t, 0)) for t, n in count.items()]


def extract(page: str | None, region: str | None, constant: frozenset) -> str:
    """Texts of the region's slots in page order; without a region, of the whole page."""
    found = []
    for path, bad, text, links in blocks(page):
        inside = not region or path == region or path.startswith(region + "/")
        if inside and not bad and text_token(text) not in constant:
            found.append(text)
    return "\n".join(found)


def _tokens(batches):
    for batch in batches:
        host, page, token, n, first, chars = [], [], [], [], [], []
        for own, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            digest = xxhash.xxh3_64_intdigest(html.encode("utf-8", "surrogatepass"))
            for t, k, f, c in page_tokens(html):
                host.append(own)
                page.append(digest - (1 << 64) if digest >> 63 else digest)
                token.append(t)
                n.append(k)
                first.append(f)
                chars.append(c)
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(page, pa.int64()), pa.array(token, pa.string()), pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(chars, pa.int64())],
                                         names=["host", "page", "token", "n", "first", "chars"])


def deduce_templates(pages: DataFrame) -> DataFrame:
    """One row per template group (a host, or null for hosts too small to have one): region and constant texts.

    Columns: host, n_pages, region (path of the main container), constant (digests of template texts).
    """
    filled = pages.select(host(), "url", "html").where("html <> ''")
    tokens = filled.select("host", "html").mapInArrow(_tokens, "host string, page long, token string, n long, first long, chars long")
    # occurrence vectors as fingerprints: sum over pages of a page's hash times the count, modulo a prime-sized range
    mark = F.pmod(F.xxhash64("page"), F.lit(2_147_483_647))
    vectors = tokens.groupBy("host", "token").agg(
        F.count("*").alias("pages"), F.min("n").alias("least"), F.max("n").alias("most"), F.sum(F.pmod(mark * F.col("n"), F.lit(2_147_483_647))).alias("vector"),
        F.avg("first").alias("place"), F.sum("chars").alias("chars"))
    vectors = stored(vectors, "html-vectors")
    size = filled.groupBy("host").agg(F.count("*").alias("n_pages"), F.countDistinct(F.xxhash64("url", "html")).alias("different"))
    size = stored(size, "html-hosts")
    vectors = vectors.join(size, "host").withColumn("own", F.col("different") >= MIN_PAGES)
    group = F.when(F.col("own"), F.col("host"))
    vectors = vectors.where(F.col("own") | ~F.startswith("token", F.lit("#"))).withColumn("group", group)
    merged = vectors.groupBy("group", "own", "token").agg(F.sum("pages").alias("pages"), F.min("least").alias("least"), F.max("most").alias("most"), F.sum("vector").alias("vector"), F.avg("place").alias("place"), F.sum("chars").alias("chars"))
    total = size.withColumn("group", F.when(F.col("different") >= MIN_PAGES, F.col("host"))).groupBy("group").agg(F.sum("n_pages").alias("n_pages"), F.sum("different").alias("different"))
    merged = merged.join(total.withColumnRenamed("group", "g"), F.col("group").eqNullSafe(F.col("g"))).drop("g")
    # classes: tokens on every page with one vector; the outer one stands once on each, the others nest in its slots
    every = merged.where(F.col("pages") == F.col("n_pages"))
    outer = every.where("least = 1 and most = 1")
    container = F.regexp_extract("token", r"/([a-z0-9]+)[^/]*$", 1).isin(*sorted(CONTAINER))
    deepest = Window.partitionBy("group").orderBy(F.length(F.regexp_replace("token", "[^/]", "")).desc(), "place", "token")
    readable = merged.groupBy(F.col("group").alias("g")).agg(F.max("chars").alias("all_chars"))
    boxes = outer.where(container).join(readable, F.col("group").eqNullSafe(F.col("g"))).where((F.col("all_chars") > 0) & (F.col("chars") >= SHARE * F.col("all_chars")))
    region = boxes.withColumn("k", F.row_number().over(deepest)).where("k = 1").select(F.col("group").alias("g1"), F.col("token").alias("region"))
    # a text is part of the template when its class holds an element too (it comes and goes with that element)
    is_text = F.startswith("token", F.lit("#"))
    tagged = every.where(~is_text).select(F.col("group").alias("g"), F.col("vector").alias("v")).distinct()
    texts = every.where(is_text & (F.col("different") >= MIN_TEXT_PAGES)).join(tagged, (F.col("group") == F.col("g")) & (F.col("vector") == F.col("v")))
    constant = texts.groupBy(F.col("group").alias("g2")).agg(F.collect_list("token").alias("constant"))
    return (total.join(region, F.col("group").eqNullSafe(F.col("g1")), "left").join(constant, F.col("group").eqNullSafe(F.col("g2")), "left")
            .select(F.col("group").alias("host"), "n_pages", "region", "constant"))


def _extract(batches):
    for batch in batches:
        texts = [extract(h, r, frozenset(c or ())) for h, r, c in zip(*(batch.column(k).to_pylist() for k in ("html", "region", "constant")))]
        yield pa.RecordBatch.from_arrays([batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), batch.column("host"), batch.column("region")],
                                         names=["page_id", "url", "text", "n_chars", "host", "region"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars, host, region."""
    pages = pages.select("page_id", "url", "html")
    templates = stored(deduce_templates(pages), "html-templates")
    own = templates.where("host is not null")
    shared = templates.where("host is null").select(F.col("region").alias("r"), F.col("constant").alias("c"))  # one row or none
    rows = pages.select("*", host()).join(own, "host", "left").join(F.broadcast(shared), F.lit(True), "left")
    rows = rows.select("page_id", "url", "html", "host", F.when(F.col("n_pages").isNotNull(), F.col("region")).otherwise(F.col("r")).alias("region"),
                       F.when(F.col("n_pages").isNotNull(), F.col("constant")).otherwise(F.col("c")).alias("constant"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long, host string, region string")
