"""HTML main text by wrappers: union-free expressions inferred from the pages of a host."""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.base import query, staged, table

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>?"""
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
# Elements by how HTML treats them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CLOSED_BY_SAME = frozenset("li dt dd tr td th option p".split())
# Elements, and words in class, id and role, that mark what is not the article.
SIDE_TAGS = frozenset("nav header footer aside form head title script style noscript template button select textarea iframe menu dialog svg".split())
SIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead menu modal nav navbar navigation "
    "newsletter notice notification pagination popup promo promotion related respond search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
COMMENT_WORDS = frozenset("comment comments disqus respond".split())
MAIN_TAGS = frozenset(("article", "main"))
# Elements whose side words say something of the page, not of themselves.
FRAME_TAGS = frozenset(("html", "body", "article", "main"))
# Elements that lay a page out. A region is one of these, never a paragraph, a heading or a list.
CONTAINERS = frozenset("html body div section article main center form table tbody tr td".split())
BESIDE = CONTAINERS - {"table", "tbody"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An element is the region if it has this share of its parent's text; an article or main element needs less.
MOST = 0.6
NAMED = 0.25
# Text of the template is on this many pages of the host at least, and on this share of them.
SEVERAL = 3
NEARLY_ALL = 0.9
# An element inside an article that only part of a name calls a side element is none if it has this share
# of the article's text or so many letters a page, and less than half of them in links; one that a whole name does needs half.
PART_NAMED = 0.25
PROSE = 120
WHOLE_NAMED = 0.5
SALTS = 64
HOSTS = 2_000


def runs_of(page: str) -> Iterator[tuple[tuple[str, ...], str, bool, int]]:
    """Text runs of a page in order: labels of the open elements, decoded text, whether a block ends before it, and
    how many of the elements were open since the run before.

    A label is the tag with the words of its class, id and role. Void and unclosed
    elements are closed as HTML does; a stray end tag is passed over.
    """
    path: list[str] = []
    tags: list[str] = []
    broken, low = True, 0
    for m in TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            yield tuple(path), html.unescape(text), broken, low
            broken, low = False, len(path)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        broken |= tag not in INLINE
        if tag == "br":
            yield tuple(path), " ", broken, low
            broken, low = False, len(path)
        elif m["end"]:
            if tag in tags:
                at = len(tags) - 1 - tags[::-1].index(tag)
                # An end tag of an inline element does not close blocks around it.
                if tag not in INLINE or all(t in INLINE for t in tags[at:]):
                    del tags[at:], path[at:]
                    low = min(low, at)
        elif tag not in VOID and not m["rest"].endswith("/"):
            for t in ("p",) if tag in CLOSES_P else (tag,) if tag in CLOSED_BY_SAME else ():
                if t in tags:
                    at = len(tags) - 1 - tags[::-1].index(t)
                    if all(x in INLINE for x in tags[at + 1 :]):
                        del tags[at:], path[at:]
                        low = min(low, at)
            rest = m["rest"]
            words = sorted({w.replace(".", "-") for x in NAMES.findall(rest) for w in "".join(x).lower().split()}) if "=" in rest else ()
            tags.append(tag)
            path.append(".".join((tag, *words)))


def tag_of(label: str) -> str:
    return label.split(".", 1)[0]


def is_named_side(label: str) -> bool:
    """Whether a whole name of the element, or a part of one that speaks of comments, is that of a side element."""
    tag, *names = label.split(".")
    if tag in FRAME_TAGS:
        return False
    return any(n in SIDE_WORDS or not COMMENT_WORDS.isdisjoint(re.split("[_-]+", n)) for n in names)


def is_side(label: str, inside: bool) -> bool:
    """Whether tag or names are those of a side element; a part of a name will do, as in ``main-nav``.

    A header ``inside`` an article or main element has the article's own headline.
    """
    tag, *names = label.split(".")
    if tag in SIDE_TAGS:
        return not (inside and tag == "header")
    return tag not in FRAME_TAGS and any(not SIDE_WORDS.isdisjoint(re.split("[_-]+", n)) for n in names)


def may_be_side(label: str, inside: bool) -> bool:
    """Whether the label speaks of a side element but the text may speak against it: words, and a form around the page."""
    return is_side(label, inside) and (tag_of(label) == "form" or tag_of(label) not in SIDE_TAGS)


# --- union-free expressions -------------------------------------------------------------


@dataclass
class Item:
    """A part of a wrapper: an element, or text if ``label`` is ``#``. ``value`` None is a slot, else the one text known.

    ``pages`` is the number of pages that have it.
    """

    label: str
    value: str | None = None
    chars: int = 0
    optional: bool = False
    repeated: bool = False
    pages: int = 1
    inside: list[Item] = field(default_factory=list)

    def plain(self) -> list:
        return [self.label, self.value, self.chars, self.optional, self.repeated, self.pages, [i.plain() for i in self.inside]]

    @staticmethod
    def of(x: list) -> Item:
        return Item(*x[:6], [Item.of(y) for y in x[6]])


def page_items(page: str) -> list[Item]:
    """The page as nested items; text runs keep a digest of their text."""
    root = Item("")
    stack, low = [root], 0
    for path, text, _, open_since in runs_of(page):
        low = min(low, open_since)
        text = " ".join(text.split())
        if not text:
            continue
        keep = 0
        while keep < min(low, len(path)) and keep + 1 < len(stack) and stack[keep + 1].label == path[keep]:
            keep += 1
        low = len(path)
        del stack[keep + 1 :]
        for label in path[keep:]:
            stack.append(Item(label))
            stack[-2].inside.append(stack[-1])
        stack[-1].inside.append(Item("#", hashlib.md5(text.encode()).hexdigest()[:12], len(text)))
    return fold(root.inside)


def fold(items: list[Item]) -> list[Item]:
    """Neighbours of one label become one repeated item, and then neighbouring equal pairs of labels."""
    out: list[Item] = []
    for item in items:
        item.inside = fold(item.inside) if not item.repeated else item.inside
        if out and out[-1].label == item.label:
            out[-1] = merged(out[-1], item, True)
            out[-1].repeated = True
        elif len(out) >= 3 and out[-2].label == item.label and out[-1].label == out[-3].label:
            second = out.pop()
            out[-2] = merged(out[-2], second, True)
            out[-1] = merged(out[-1], item, True)
            out[-1].repeated = out[-2].repeated = True
        else:
            out.append(item)
    return out


def merged(a: Item, b: Item, one_page: bool = False) -> Item:
    """One item that covers both: differing text becomes a slot, contents are aligned. Pages add up unless both are of ``one_page``."""
    value = a.value if a.value == b.value else None
    pages = max(a.pages, b.pages) if one_page else a.pages + b.pages
    return Item(a.label, value, a.chars + b.chars, a.optional or b.optional, a.repeated or b.repeated, pages, align(a.inside, b.inside, one_page))


def align(a: list[Item], b: list[Item], one_page: bool = False) -> list[Item]:
    """Longest common sequence of labels; what one side lacks becomes optional."""
    n, m = len(a), len(b)
    if [x.label for x in a] == [y.label for y in b]:
        return [merged(x, y, one_page) for x, y in zip(a, b, strict=True)]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i].label == b[j].label else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i].label == b[j].label:
            out.append(merged(a[i], b[j], one_page))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            a[i].optional = True
            out.append(a[i])
            i += 1
        else:
            b[j].optional = True
            out.append(b[j])
            j += 1
    return fold(out)


def page_wrapper(page: str) -> Item:
    """The wrapper of one page; one without text is a wrapper of no page."""
    items = page_items(page)
    return Item("", pages=1 if items else 0, inside=items)


def roles(wrapper: Item) -> dict:
    """What a host's wrapper says of its pages. Elements are named by their labels from the top, joined by blanks.

    ``fixed``: text of the template by element: on ``SEVERAL`` pages or more and on nearly all, always the same. All
    other text is the page's own. ``own``: elements that look like side elements by a word but have most of the own text,
    and no article element is elsewhere; or that are inside an article and have much of its text, see ``PART_NAMED``. ``through``: for an element, those inside it that are the region of a page that
    has them: layout elements, not repeated, with ``MOST`` of the own text; for an article or main element ``NAMED`` of
    it will do. What is optional is compared with what can stand on the same pages, so each template of a host has
    its own way down.
    """
    total_pages = max(wrapper.pages, 1)
    fixed: dict[str, list[str]] = {}
    own: set[str] = set()
    through: dict[str, list[str]] = {}

    def is_fixed(item: Item) -> bool:
        return item.value is not None and item.pages >= SEVERAL and item.pages >= NEARLY_ALL * total_pages

    def below(path: str, item: Item) -> str:
        return f"{path} {item.label}" if path else item.label

    def weigh(item: Item, path: str, words: bool, inside: bool = False) -> tuple[int, int, int]:
        """Own text in the element, that in article elements, and that in links; without what side words mark unless ``words``."""
        if item.label == "#":
            return (0 if is_fixed(item) else item.chars), 0, 0
        if item.label and is_side(item.label, inside) and path not in own and not (words and may_be_side(item.label, inside)):
            return 0, 0, 0
        tag = tag_of(item.label)
        chars = named = linked = 0
        for x in item.inside:
            n, m, k = weigh(x, below(path, x), words, inside or tag in MAIN_TAGS)
            chars, named, linked = chars + n, named + m, linked + k
        return chars, chars if tag in MAIN_TAGS else named, chars if tag == "a" else linked

    whole, named_whole, _ = weigh(wrapper, "", True)

    def find_own(item: Item, path: str, article: tuple[int, int] | None) -> None:
        """``article``: own text and pages of the article or main element around."""
        for x in item.inside:
            here = below(path, x)
            inside = article is not None
            if x.label == "#" or is_side(x.label, inside) and not may_be_side(x.label, inside):
                continue
            n, m, linked = weigh(x, here, True, inside)
            if is_side(x.label, inside):
                if inside:
                    share = n * article[1] / max(1, article[0] * x.pages)
                    much = share > WHOLE_NAMED if is_named_side(x.label) else share > PART_NAMED or n > PROSE * x.pages
                    keep = much and 2 * linked < n
                else:
                    keep = 2 * n * total_pages > whole * x.pages and m == named_whole
                if keep:
                    own.add(here)
            find_own(x, here, article or ((n, x.pages) if tag_of(x.label) in MAIN_TAGS else None))

    find_own(wrapper, "", None)

    def descend(items: list[Item], path: str, pages: int, inside: bool) -> None:
        found: dict[str, list] = {}
        for x in items:
            if x.label == "#":
                if is_fixed(x):
                    fixed.setdefault(path, []).append(x.value)
                found.setdefault("#", []).append((x, (weigh(x, path, False)[0], 0)))
            elif (here := below(path, x)) in own or not is_side(x.label, inside):
                found.setdefault(x.label, []).append((x, weigh(x, here, False, inside)[:2]))
        kinds = {k: (sum(w[0] for _, w in v), sum(w[1] for _, w in v), max(x.pages for x, _ in v), len(v) > 1 or v[0][0].repeated) for k, v in found.items()}
        for label, (chars, named, seen, repeated) in kinds.items():
            if label == "#" or not chars:
                continue
            beside = sum(n * min(1, seen / p) for k, (n, _, p, _) in kinds.items() if k != label and p + seen > pages)
            fits = chars >= MOST * (chars + beside) and tag_of(label) in CONTAINERS and not repeated
            if fits or named and named >= NAMED * (chars + beside):
                through.setdefault(path, []).append(label)
        for label, items_ in found.items():
            for x, _ in items_:
                if label != "#":
                    descend(x.inside, below(path, x), x.pages, inside or tag_of(label) in MAIN_TAGS)

    descend(wrapper.inside, "", total_pages, False)
    return {"through": through, "fixed": fixed, "own": sorted(own)}


def main_text(page: str, role: dict) -> str:
    """The text of the page's region by its host's roles. If they leave nothing of a page without article
    element, the page is read by roles of its own."""
    runs = list(runs_of(page))
    text = region_text(runs, role)
    if not text and runs and not any(tag_of(x) in MAIN_TAGS for path, *_ in runs for x in path):
        text = region_text(runs, roles(page_wrapper(page)))
    return text


def region_text(runs: list[tuple[tuple[str, ...], str, bool, int]], role: dict) -> str:
    through, fixed, own = role["through"], role["fixed"], set(role["own"])
    cache: dict[tuple, tuple[bool, list[str]]] = {}
    there: set[str] = set()
    for path in {path for path, text, *_ in runs if text.strip()}:
        there.update(" ".join(path[:k]) for k in range(1, len(path) + 1))
    blocks: list[list[str]] = [[]]
    gap = False

    def in_region(path: tuple[str, ...]) -> bool:
        names = [" ".join(path[:k]) for k in range(len(path) + 1)]
        main = next((k for k, x in enumerate(path) if tag_of(x) in MAIN_TAGS), len(path))
        if any(is_side(x, k > main) and names[k + 1] not in own for k, x in enumerate(path)):
            return False
        for k, name in enumerate(names):
            ways = [x for x in through.get(name, ()) if (f"{name} {x}" if name else x) in there]
            if not ways:
                return True
            named = any(tag_of(x) in MAIN_TAGS for x in ways)
            if k == len(path):
                return not named
            if path[k] not in ways:
                tag = tag_of(path[k])
                return tag in HEADINGS or tag not in BESIDE and not named
            if tag_of(path[k]) in MAIN_TAGS:
                return True
        return True

    for path, text, broken, _ in runs:
        gap |= broken
        if path not in cache:
            cache[path] = in_region(path), fixed.get(" ".join(path), [])
        wanted, same = cache[path]
        if not wanted:
            gap = gap or bool(text.strip())
            continue
        if same and (squeezed := " ".join(text.split())) and hashlib.md5(squeezed.encode()).hexdigest()[:12] in same:
            continue
        if gap:
            blocks.append([])
            gap = False
        blocks[-1].append(text)
    squeezed = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(b for b in squeezed if b)


def host_of(url: str | None) -> str:
    return re.sub(r"^[a-zA-Z][\w+.-]*://", "", url or "").split("/")[0].split("?")[0].split("#")[0].lower()


def infer_wrappers(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper as JSON) of every host, from all its pages.

    A task aligns the pages it reads, host by host, and sends one wrapper a host (it keeps
    ``HOSTS`` at a time); wrappers are then aligned in two steps, by (host, salt) and by host, so
    a host of any share of the pages never meets in one task. The html is not shuffled.
    """

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Item] = {}

        def flush() -> pa.RecordBatch:
            names, found = list(known), [json.dumps(w.plain()) for w in known.values()]
            known.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.string())], ["host", "wrapper"])

        for batch in batches:
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                host, own = host_of(url), page_wrapper(page.as_py() or "")
                known[host] = merged(known[host], own) if host in known else own
                if len(known) > HOSTS:
                    yield flush()
        yield flush()

    def combine(group: pa.Table) -> pa.Table:
        whole: Item | None = None
        for text in sorted(group.column("wrapper").to_pylist()):
            part = Item.of(json.loads(text))
            whole = part if whole is None else merged(whole, part)
        return pa.table({"host": [group.column("host")[0].as_py()], "wrapper": [json.dumps(whole.plain())]})

    parts = pages.select(url_col, html_col).mapInArrow(infer, "host string, wrapper string")
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    some = salted.groupBy("host", "salt").applyInArrow(combine, "host string, wrapper string")
    return some.groupBy("host").applyInArrow(combine, "host string, wrapper string")


def extract_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page: its main text by its host's wrapper.

    Blocks in page order, white space within one blank, character references decoded. The hosts'
    roles are written to the shared folder; Spark broadcasts them if that table is small and
    sorts both sides by host otherwise.

    Null or empty html gives the empty text; a null url is a host of its own; repeated rows stay;
    an empty table gives an empty result; only the three named columns are read.
    """
    kind = pages.schema[id_col].dataType.simpleString()

    def role_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [json.dumps(roles(Item.of(json.loads(w)))) for w in batch.column("wrapper").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(found, pa.string())], ["host", "roles"])

    by_host = staged(infer_wrappers(pages, url_col=url_col, html_col=html_col).mapInArrow(role_rows, "host string, roles string"), "host-roles")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, dict] = {}
            texts = []
            for page, text in zip(batch.column("html"), batch.column("roles").to_pylist(), strict=True):
                if text not in seen:
                    seen[text] = json.loads(text) if text else roles(Item(""))
                texts.append(main_text(page.as_py() or "", seen[text]))
            columns = [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^(?:[a-zA-Z][\w+.-]*://)?([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    joined = rows.join(by_host, "host", "left").select("id", "url", "html", "roles")
    return joined.mapInArrow(apply, f"page_id {kind}, url string, text string, n_chars long")


@query("op8_main_text")
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
