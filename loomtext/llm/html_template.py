"""Main text of web pages by template deduction over equivalence classes.

1. Every page is cut into tokens: opening tags with their place in the page
   (the path of tag names, with the words of class and id) and text blocks with
   their place. The occurrence vector of a token (how often it stands on each
   page of its host) is summed into a signature: occurrences, pages, and the sum
   of count * hash(page). Tokens of a host with equal signatures share their
   vector; such a group is an equivalence class.
2. Vectors are summed over a host's pages and over each of its layouts (pages
   whose main element has the same path; without one, the same outer elements).
   A class is valid when it stands on at least ``support`` of the pages of the
   host or of the layout (and on ``min_pages`` at least) and has two tokens or
   more, or is nested in a valid class (its path continues the path of a token
   of one). The tokens of valid classes are the template; what stands between
   them are slots.
3. On every page the template's text blocks go; what is left are the slots, each in
   the containers around it. The main slot is chosen by evidence, summed up the tree of containers: the
   characters outside links, ``ARTICLE`` times as many inside <article> or <main>, none where
   an element, role or class says menu, header, footer, sidebar, notice, advert,
   form, script, style or reader comment. From the top, the way goes down to the
   container that has over half of the evidence, as long as there is one; the last template container
   on that way (or, on hosts too small for a template, the last container) is the main one and
   its slots are joined in page order, those of <article> or <main> only where these have over half. Where
   the main one holds template text and no slot, most of the host's pages are copies of this one: it is kept whole.

A class names a kind by all of its words ("cookie-banner", not "related-work"); ids do so outside an
article only. A form that holds over half of the page's evidence wraps the page and is no form.

Signatures are sums, so a host with a third of all pages is combined in every
task before the shuffle. A template is no larger than the pages it is common to;
a host's templates are joined to its pages by host.

Defined cases: null or empty html gives "", 0; null urls share a host of their
own; unclosed, crossing and unknown tags are taken as browsers take them;
repeated rows are extracted each; other columns are ignored.
"""
from __future__ import annotations

import hashlib
import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, scratch_table

SUPPORT = 0.8
MIN_PAGES = 5
ARTICLE = 16  # a character of an article counts as so many
TALLY_ROWS = 200_000  # tokens a task counts before it passes them on

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol optgroup option "
                  "p pre section summary table tbody td tfoot th thead tr ul".split())
OUT = frozenset("nav header footer aside button select input label script style noscript template svg math "
                "textarea iframe head title menu dialog object embed canvas".split())
OUT_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
                      "cookies consent gdpr notice alert sidebar menu nav navbar navigation breadcrumb breadcrumbs "
                      "footer header masthead comment comments reply replies disqus share sharing social related "
                      "recommended subscribe newsletter signup popup modal overlay widget toolbar pagination pager "
                      "skip".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
CLOSES_P = BLOCK - {"body", "html"}
MAIN = ("article", "main")
CONTAINER = frozenset("html body div section article main center table tbody td figure form details dd blockquote".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z]+")
HOST = r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]*)"


def number(*parts: str) -> int:
    """63-bit hash of a token."""
    return int.from_bytes(hashlib.blake2b("\x00".join(parts).encode("utf-8", "surrogatepass"),
                                          digest_size=8).digest(), "little") >> 1


def events(page: str):
    """Yield ("open", tag, attributes), ("close", tag, ""), ("text", text, "") in page order."""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:], ""
            return
        if lt > at:
            yield "text", page[at:lt], ""
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt) or _LOOSE_TAG.match(page, lt)
        if not m:
            yield "text", "<", ""
            at = lt + 1
            continue
        at, tag = m.end(), m[2].lower()
        if m[1]:
            yield "close", tag, ""
            continue
        yield "open", tag, m[3]
        if tag in RAW and not m[3].rstrip().endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = close.start() if close else n
        elif tag in VOID or m[3].rstrip().endswith("/") and tag not in BLOCK:
            yield "close", tag, ""


def _attributes(text: str, strict: bool) -> tuple[list[str], bool]:
    """(words of class and id, whether they, the role or hidden name a part that is no main text)."""
    words, out = [], False
    for m in _ATTR.finditer(text):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            words += _WORD.findall(value)
            for label in value.split():
                told = _WORD.findall(label)
                if told and OUT_WORDS.issuperset(told) and (name == "class" or not strict):
                    out = True
        elif name == "role":
            out |= value.strip() in OUT_ROLES
        elif name == "hidden":
            out = True
        elif name == "aria-hidden":
            out |= value == "true"
    return words, out


class Block:
    """A run of text between block borders, with what stands around it."""

    __slots__ = ("text", "path", "out", "main", "linked", "form")

    def __init__(self, text, path, out, main, linked, form):
        self.text, self.path, self.out, self.main, self.linked, self.form = text, path, out, main, linked, form


class Page:
    """blocks in page order; parents: path number -> that of the path above (in order of first opening, 0 the page);
    opened: path number -> how often; containers: paths of elements that hold others; main: path of the first article (0 without); outer: paths of the first levels."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.parents: dict[int, int] = {}
        self.opened: dict[int, int] = {}
        self.containers: set[int] = set()
        self.main = 0
        self.outer: set[int] = set()


# an open element: tag, path, left out, in main, path of the innermost block element, depth, number of the form around (0: none)
_TOP = ("", 0, False, False, 0, 0, 0)


def parse(page: str | None) -> Page:
    """The page's text blocks and paths, in one pass whose cost does not grow with the depth."""
    found = Page()
    stack: list[tuple] = []
    open_tags: dict[str, int] = {}
    numbers: dict[tuple[int, str], int] = {}
    parts: list[str] = []
    linked = forms = 0

    def flush():
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            inner = stack[-1] if stack else _TOP
            found.blocks.append(Block(text, inner[4], inner[2], inner[3], linked >= len(text), inner[6]))
        parts.clear()
        linked = 0

    def cut_to(depth: int):
        if any(s[0] in BLOCK or s[2] for s in stack[depth:]):
            flush()
        for s in stack[depth:]:
            open_tags[s[0]] -= 1
        del stack[depth:]

    def close_inside(tag: str, borders):
        """Close the innermost open ``tag`` unless one of the borders is open inside it."""
        if open_tags.get(tag):
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    cut_to(depth)
                    return
                if stack[depth][0] in borders:
                    return

    for kind, what, attributes in events(page or ""):
        if kind == "text":
            if stack and stack[-1][0] in RAW:
                continue
            text = entities.unescape(what) if "&" in what else what
            parts.append(text)
            if open_tags.get("a"):
                linked += len(text)
            continue
        if kind == "close":
            if open_tags.get(what):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == what:
                        cut_to(depth)
                        break
                    if stack[depth][0] in MAIN and what not in (*MAIN, "body", "html"):
                        break  # a stray end tag doesn't close the article
            if what in BLOCK:
                flush()
            continue
        words, named = _attributes(attributes, bool(stack) and stack[-1][3]) if attributes else ([], False)
        own = what in OUT or named
        if what in MAIN and not own and stack and not stack[-1][3] and stack[-1][2]:
            # a menu or advert that was never closed ends where the article begins
            depth = next(i for i, s in enumerate(stack) if s[2])
            if not any(s[7] for s in stack[depth:]):
                cut_to(depth)
        if what in CLOSES_P:
            close_inside("p", BLOCK)
        if what == "li":
            close_inside("li", ("ul", "ol", "menu"))
        above = stack[-1] if stack else _TOP
        if own and what == "header" and above[3] and above[0] in MAIN and not named:
            own = False  # the article's own heading
        if what in BLOCK or own:
            flush()
        if what == "br":
            parts.append(" ")
        label = what + ("." + ".".join(words) if words else "")
        path = numbers.get((above[1], label))
        if path is None:
            path = numbers[above[1], label] = number("path", str(above[1]), label)
            found.parents[path] = above[1]
            if what in CONTAINER:
                found.containers.add(path)
            if above[5] < 3:
                found.outer.add(path)
        found.opened[path] = found.opened.get(path, 0) + 1
        if not found.main and what in MAIN and not (above[2] or own):
            found.main = path
        form = above[6]
        if what == "form" and not form:
            forms += 1
            form = forms
        stack.append((what, path, above[2] or own, above[3] or what in MAIN, path if what in BLOCK else above[4], above[5] + 1,
                      form, "comment" in label))
        open_tags[what] = open_tags.get(what, 0) + 1
    flush()
    # a form that wraps the page is no form
    weight: dict[int, int] = {}
    for b in found.blocks:
        if not b.out and not b.linked:
            weight[b.form] = weight.get(b.form, 0) + len(b.text) * (ARTICLE if b.main else 1)
    for b in found.blocks:
        if b.form and weight.get(b.form, 0) * 2 <= sum(weight.values()):
            b.out = True
    return found


def layout_of(page: Page) -> int:
    """Pages of a host with equal layouts share the path of the article, or else their outer elements."""
    return number("article", str(page.main)) if page.main else number("outer", *map(str, sorted(page.outer)))


def text_token(b: Block) -> int:
    return number("text", str(b.path), b.text)


def tokens_of(page: Page) -> dict[int, tuple[int, int, int]]:
    """Token -> (count on the page, its path, the path it continues)."""
    out = {number("tag", str(path)): (n, path, page.parents[path]) for path, n in page.opened.items()}
    for b in page.blocks:
        key = text_token(b)
        out[key] = (out[key][0] + 1 if key in out else 1, b.path, b.path)
    return out


def token_vectors(pages: DataFrame) -> DataFrame:
    """(host, layout, token, path, parent, pages, occurrences, signature): a token's occurrence vector, summed.

    Layout 0 is the whole host. Token 0 counts the pages."""
    schema = "host string, layout long, token long, path long, parent long, pages long, occurrences long, signature long"
    arrow = pa.schema([("host", pa.string()), ("layout", pa.int64()), ("token", pa.int64()), ("path", pa.int64()), ("parent", pa.int64()),
                       ("pages", pa.int64()), ("occurrences", pa.int64()), ("signature", pa.int64())])

    def table(tally):
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in tally], pa.string()), *(pa.array([k[i] for k in tally], pa.int64()) for i in (1, 2)),
             *(pa.array([v[i] for v in tally.values()], pa.int64()) for i in range(5))], schema=arrow)

    def run(batches):
        tally: dict[tuple[str, int, int], list] = {}
        for batch in batches:
            for page_id, host, page in zip(*(c.to_pylist() for c in batch.columns)):
                weight = number("page", str(page_id)) & 0xFFFFFFFF
                parsed = parse(page)
                found = tokens_of(parsed)
                found[0] = (1, 0, 0)
                for layout in (0, layout_of(parsed)):
                    for token, (count, path, parent) in found.items():
                        row = tally.get((host, layout, token))
                        if row is None:
                            row = tally[(host, layout, token)] = [path, parent, 0, 0, 0]
                        row[2] += 1
                        row[3] += count
                        row[4] += count * weight
            if len(tally) > TALLY_ROWS:
                yield table(tally)
                tally = {}
        if tally:
            yield table(tally)

    return (pages.select("page_id", "host", "html").mapInArrow(run, schema)
            .groupBy("host", "layout", "token").agg(F.min("path").alias("path"), F.min("parent").alias("parent"),
                                                    F.sum("pages").alias("pages"),
                                          F.sum("occurrences").alias("occurrences"),
                                          F.sum(F.col("signature") % F.lit(1 << 61)).alias("signature")))


def templates(pages: DataFrame, support: float = SUPPORT, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, layouts, tokens): hashes of the tokens of the host's valid classes, each with its layout (0: all)."""
    vectors = scratch_table(token_vectors(pages).where((F.col("token") == 0) | (F.col("pages") >= min_pages)), "vectors")
    group = ["host", "layout"]
    sizes = vectors.where("token = 0").select(*group, F.col("pages").alias("all_pages"))
    common = (vectors.where("token <> 0").join(sizes, group)
              .where((F.col("pages") >= min_pages) & (F.col("pages") >= support * F.col("all_pages"))))
    classes = common.groupBy(*group, "pages", "occurrences", "signature").agg(F.count(F.lit(1)).alias("size"))
    classed = common.join(classes, [*group, "pages", "occurrences", "signature"])
    valid = classed.where("size >= 2").select(*group, "path").distinct()
    single = (classed.where("size < 2")
              .join(valid.withColumnRenamed("path", "parent"), [*group, "parent"], "left_semi"))
    nested = classed.where("size >= 2").select(*group, "token").unionByName(single.select(*group, "token"))
    # a token of the whole host is listed once, whatever its layouts; then there are as many tokens as
    # stand on nearly every page of the host, or of one of its layouts, at most
    once = (nested.groupBy("host", "token")
            .agg(F.min("layout").alias("least"), F.collect_set("layout").alias("layouts"))
            .select("host", "token", F.explode(F.when(F.col("least") == 0, F.array("least"))
                                               .otherwise(F.col("layouts"))).alias("layout")))
    return (once.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("layout", "token"))).alias("all"))
            .select("host", F.col("all.layout").alias("layouts"), F.col("all.token").alias("tokens")))


def main_container(page: Page, slots: list[Block], template: frozenset) -> int:
    """The path of the container whose slots are the main text; 0 for the whole page."""
    evidence = dict.fromkeys(page.parents, 0)
    evidence[0] = 0
    for b in slots:
        if not b.linked:
            evidence[b.path] += len(b.text) * (ARTICLE if b.main else 1)
    below: dict[int, tuple[int, int]] = {}  # path -> (evidence, path) of its best child
    for path in reversed(page.parents):  # children come after their parents
        up = page.parents[path]
        evidence[up] += evidence[path]
        below[up] = max(below.get(up, (0, 0)), (evidence[path], path))
    at = best = 0
    while at in below and below[at][0] * 2 > evidence[0]:
        at = below[at][1]
        if at in page.containers and (not template or number("tag", str(at)) in template):
            best = at
    return best


def main_text(page: str | None, template: frozenset | dict[int, frozenset]) -> str:
    """The page's main slots; a template by layout holds the tokens of the whole host in each."""
    parsed = parse(page)
    if isinstance(template, dict):
        template = template.get(layout_of(parsed), template[0])
    inside = [b for b in parsed.blocks if not b.out]
    slots = [b for b in inside if text_token(b) not in template] if template else inside
    weigh = lambda blocks: sum(len(b.text) * (ARTICLE if b.main else 1) for b in blocks if not b.linked)
    kept = slots or inside
    in_main = [b for b in kept if b.main]
    if in_main and weigh(in_main) * 2 > weigh(kept) or not weigh(kept):
        return " ".join(b.text for b in in_main or kept)
    if parsed.main and not in_main and not slots:
        return ""
    best = main_container(parsed, kept, template)
    under = {0: best == 0}
    for path, up in parsed.parents.items():
        under[path] = under[up] or path == best
    return " ".join(b.text for b in kept if under[b.path])


def by_layout(layouts: list[int], tokens: list[int]) -> dict[int, frozenset]:
    """Layout -> its template, that of the whole host (layout 0) included."""
    own: dict[int, set] = {0: set()}
    for layout, token in zip(layouts, tokens):
        own.setdefault(layout, set()).add(token)
    return {layout: frozenset(own[0] | mine) for layout, mine in own.items()}


def extract(pages: DataFrame, support: float = SUPPORT, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    prepare(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.col("html").cast("string")).withColumn("host", host)
    found = scratch_table(templates(rows, support, min_pages), "templates")  # small tables are then broadcast by size
    joined = rows.join(found, "host", "left").select("page_id", "url", "html", "host", "layouts", "tokens")
    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        known: tuple[str | None, dict[int, frozenset]] = (None, {0: frozenset()})
        for batch in batches:
            texts = []
            hosts, layouts, tokens = batch.column("host").to_pylist(), batch.column("layouts"), batch.column("tokens")
            for i, page in enumerate(batch.column("html")):
                if hosts[i] != known[0]:
                    known = (hosts[i], by_layout(layouts[i].as_py() or [], tokens[i].as_py() or []))
                texts.append(main_text(page.as_py(), known[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url").cast(pa.string()), pa.array(texts, pa.string()),
                 pa.array(np.array([len(t) for t in texts], dtype=np.int64))], schema=arrow)

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
