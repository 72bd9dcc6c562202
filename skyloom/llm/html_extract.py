"""Main text of web pages by deducing the template that pages of a host share.

Tokens of a page are its tags, told apart by the tags and classes around them. A host's
pages are counted by layout: the place of the first article, or, without one, of the block
with most text. Tokens on more than ``SUPPORT`` of a layout's pages are its template;
empty pages count for none. Tokens with the same occurrence vector (how often each page
has them) form an equivalence class. Vectors are compared by a sum of hashes over (page,
number), which tasks add up before the shuffle, so no host's pages are ever gathered. The
class of the tokens that occur exactly once on a page is the root of the template; classes
with more occurrences nest in the slot of their parent token. A class is valid where its
tokens nest: each token's parent is in the root or in a class that nests itself.

The tokens of valid classes cut a page into slots; a text belongs to the slot of the
innermost block around it. Article slots lie in an ``article`` or ``main`` element of the
root, or else of a valid class, or else of the page. Where a page has none, the main text
is everything outside page furniture and outside constant slots: those of valid classes
that hold one and the same text on all pages of a layout, of at least ``CONSTANT_FROM``
pages that are not all copies of one. Headings are never constant, articles are kept
whole, and a page without any other text keeps its constant slots. Tags and class names
say what is furniture: menus, headers, footers, sidebars, notices, adverts, forms and
reader comments. Copies of a page keep their text. A layout with a single page has only
its own tags as evidence.

A class, id or role name tells of furniture where all its words do ("cookie-notice"). One
with such a word among others ("related-news") does so only for an element that holds no
article and at most half of the page's text; so does a form, and words after "no" or "has"
tell nothing. A header inside an article belongs to it. Where names leave less than a
quarter of what their articles hold, elements around an article are not judged by names.

Blocks are split at block-level tags; ``<br>`` is white space. Character references are
decoded, white space runs become one space, blocks are trimmed and joined by an empty line.

Defined cases: null or empty html has an empty text; pages without any main text have an
empty text; unclosed and stray tags are tolerated; an unclosed script or comment takes
the rest of the page; pages are read whole, whatever their length; equal rows have equal
texts; depth and unclosed tags take memory and time in proportion (a path of over ``LONG_PATH``
characters stands as a digest); a null or odd url counts as the host ""; an empty table gives an empty result;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_hexdigest, xxh64_intdigest

from skyloom.llm.url_filter import host_and_path
from skyloom.session import materialise

#: In a tag a quote opens a value only straight after an equals sign; elsewhere it is a character.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*?)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
# fixed values of HTML: elements without content, with raw content, that end a block
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe noembed noframes xmp svg".split())
BLOCK = set(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
    search section select summary table tbody td tfoot th thead tr ul""".split()
)
#: Elements that hold page furniture.
FURNITURE = set(
    "nav header footer aside menu dialog button select input label fieldset head title script style "
    "noscript template iframe textarea svg object embed canvas audio video search".split()
)
#: Words in class, id and role names that tell of furniture.
FURNITURE_NAMES = set(
    """ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
    commentlist consent contentinfo cookie cookies copyright disclaimer discussion footer gdpr header
    masthead menu menubar modal nav navbar navigation newsletter notice notification pager pagination popup
    privacy promo promoted promotion related replies respond search share sharing sidebar social sponsor
    sponsored subscribe subscription toolbar topbar widget widgets""".split()
)
#: Words before a word that says what an element has or lacks, not what it is.
_ABOUT = set("has have is no not with without hide show".split())
#: How surely an element is furniture: by a part of a name or as a form, by a name, by its tag.
PERHAPS, NAMED, SURE = 1, 2, 3
MAIN = {"article", "main"}
#: An element that is closed by the start of these.
_CLOSES = {
    "p": BLOCK - {"option"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option"},
}
#: Share of a layout's pages that a token of its template exceeds.
SUPPORT = 0.5
#: Pages of a layout from which a slot with one text is constant.
CONSTANT_FROM = 3
#: Characters of a path from which elements below it are named by its digest.
LONG_PATH = 256
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}


def _names(rest: str) -> list[list[str]]:
    """The words of each class, id and role name."""
    if "=" not in rest:
        return []
    values = [
        "".join(found[1:]).lower() for found in _ATTRIBUTE.findall(rest) if found[0].lower() in ("class", "id", "role")
    ]
    names = [[w for w in re.split(r"[^a-z0-9]+", name) if w] for value in values for name in value.split()]
    return [words for words in names if words]


def _level(name: str, names: list[list[str]], hidden: bool, in_article: bool) -> int:
    """How surely an element with this tag and these names is furniture."""
    heads = {"header", "masthead"} if in_article else set()
    if hidden or name in FURNITURE and not (in_article and name == "header"):
        return SURE
    level = PERHAPS if name == "form" else 0
    if name in MAIN or name in ("html", "body"):
        return level
    for words in names:
        told = [w in FURNITURE_NAMES and w not in heads for w in words]
        if words[0] not in _ABOUT and any(told):
            level = max(level, NAMED if all(told) else PERHAPS)
    return level


class Element:
    """``slot`` is the path of the innermost block; ``out`` says that furniture is around."""

    __slots__ = ("tag", "path", "up", "level", "slot", "in_article", "holds", "size", "articles", "sure", "out", "main")

    def __init__(self, tag: str, path: str, up: Element | None, level: int):
        self.tag, self.path, self.up, self.level = tag, path, up, level
        self.slot = path if tag in BLOCK else up.slot if up else ""
        self.in_article = tag in MAIN or bool(up and up.in_article)
        self.sure = level == SURE or bool(up and up.sure)
        self.holds, self.size, self.articles = False, 0, 0
        self.out = self.main = False


def _short(path: str) -> str:
    """The path, or, where it is long, a digest of it: tokens of deep elements stay short."""
    if len(path) <= LONG_PATH:
        return path
    return "/~" + xxh64_hexdigest(path.encode("utf-8", "surrogatepass"))


def walk(page: str) -> Iterator[tuple[str, str, Element | None, bool]]:
    """Yields ("tag", path, innermost element, ends block) and ("text", raw text, innermost element, False)."""
    open_: list[Element] = []
    # places of the blocks among the open elements, and how many are open by tag
    blocks: list[int] = []
    tags: Counter[str] = Counter()

    def close(k: int) -> None:
        tags.subtract(e.tag for e in open_[k:])
        del open_[k:]
        while blocks and blocks[-1] >= k:
            blocks.pop()

    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if found is None:
            yield "text", page[at:], open_[-1] if open_ else None, False
            return
        if found.start() > at:
            yield "text", page[at : found.start()], open_[-1] if open_ else None, False
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["close"]:
            if tags[name]:
                k = len(open_) - 1
                while open_[k].tag != name:
                    k -= 1
                yield "tag", "/" + open_[k].path, open_[-1], bool(blocks and blocks[-1] >= k)
                close(k)
            elif name in BLOCK:  # a stray end still ends the block
                yield "tag", "//" + name, open_[-1] if open_ else None, True
            continue
        if name in BLOCK:
            # formatting elements do not hold a block open, nor does a paragraph
            for k in reversed(blocks):
                if name in _CLOSES.get(open_[k].tag, ()):
                    close(k)
                elif open_[k].tag not in _CLOSES:
                    break
        names = _names(found["rest"])
        up = open_[-1] if open_ else None
        path = f"{_short(up.slot) if up else ''}/{name}" + "".join("." + w for n in names for w in n if not w.isdigit())
        hidden = bool(_HIDDEN.search(found["rest"]))
        element = Element(name, path, up, _level(name, names, hidden, bool(up and up.in_article)))
        yield "tag", path, element, name in BLOCK
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
        elif name not in VOID and not found["rest"].endswith("/") or name in BLOCK and name not in VOID:
            if name in BLOCK:
                blocks.append(len(open_))
            tags[name] += 1
            open_.append(element)


def _opens(event: tuple) -> bool:
    kind, value, top, _ = event
    return kind == "tag" and top is not None and value == top.path


def settled(page: str) -> list[tuple[str, str, Element | None, bool]]:
    """The events of ``walk``, with ``out`` of every element settled from the whole page."""
    events = list(walk(page))
    opened = [event[2] for event in events if _opens(event)]
    total = 0
    for e in opened:
        if e.tag in MAIN and not e.sure:
            while e is not None and not e.holds:
                e.holds, e = True, e.up
    for kind, value, top, _ in events:
        if kind == "text" and not (top and top.sure):
            n = len(value.strip())
            total += n
            if top:
                top.size += n
                top.articles += n * top.in_article
    for e in reversed(opened):
        if e.up:
            e.up.size += e.size
            e.up.articles += e.articles

    def settle(by_name: bool) -> tuple[int, int]:
        """Text that is left, and text of articles that names leave out."""
        left, lost, inner = total, 0, 0
        for e in opened:
            away = bool(e.up and e.up.out)
            e.out = away or e.level == SURE
            if not e.out and e.level == NAMED:
                e.out = by_name or not e.holds
            elif not e.out and e.level == PERHAPS:
                e.out = not e.holds and 2 * e.size <= left_of_page
            if e.out and not away and not e.sure:
                inner += e.size
                lost += e.articles if e.holds else 0
        return left - inner, lost

    # text in named furniture is no part of the page's
    left_of_page = total
    left_of_page, _ = settle(True)
    left, lost = settle(True)
    if lost > 4 * left:
        left_of_page = total
        settle(False)
    return events


def occurrences(events: list[tuple]) -> Counter[tuple[str, str]]:
    """How often each (tag token, parent) occurs; texts and closing tags are no tokens of the template."""
    opened = (event[2] for event in events if _opens(event))
    return Counter((e.path, e.up.slot if e.up else "") for e in opened)


def slot_texts(events: list[tuple]) -> dict[str, str]:
    """The text directly in each block token, of all its occurrences on the page."""
    texts: dict[str, list[str]] = {}
    for kind, value, top, _ in events:
        if kind == "text" and not value.isspace() and not (top and top.out):
            texts.setdefault(top.slot if top else "", []).append(" ".join(value.split()))
    return {slot: " ".join(parts) for slot, parts in texts.items()}


def layout_of(events: list[tuple], texts: dict[str, str]) -> str:
    """Where the page's first article is, or else its block with most text, to three levels."""
    for event in events:
        if _opens(event) and event[2].tag in MAIN and not event[2].out:
            return event[1]
    most = max(texts, key=lambda slot: (len(texts[slot]), slot), default="")
    return "/".join(most.split("/")[:4])


def with_layouts(pages: DataFrame) -> DataFrame:
    """The columns of ``pages`` and the layout of each; pages without text or tags have null."""

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            at = batch.schema.get_field_index("html")
            layouts = []
            for page in batch.column(at):
                page = page.as_py() or ""
                events = settled(page)
                layouts.append(layout_of(events, slot_texts(events)) if page and not page.isspace() else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(layouts, pa.string())], [*batch.schema.names, "layout"]
            )

    return pages.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in pages.dtypes) + ", layout string")


def host_templates(pages: DataFrame) -> DataFrame:
    """(host, layout, token, parent, vector, at_once, constant): the templates' tokens.

    ``vector`` is equal for tokens of one equivalence class. ``at_once`` tokens occur
    exactly once on each page that has them: they are the root class. ``constant`` tokens
    hold the same text on every page that has them.
    """

    def run(batches: Iterator):
        import pyarrow as pa

        def digest(text: str) -> int:
            return xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1

        for batch in batches:
            sums: dict[tuple[str, str, str, str], list[int]] = {}
            for host, number, page in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True
            ):
                page = page.as_py() or ""
                if not page or page.isspace():
                    continue
                events = settled(page)
                texts = slot_texts(events)
                layout = layout_of(events, texts)
                # the token "" stands for the whole page
                whole = digest("\n".join(f"{slot} {text}" for slot, text in sorted(texts.items())))
                for (token, parent), n in [*occurrences(events).items(), (("", ""), 1)]:
                    text = digest(texts.get(token, "")) if token else whole
                    held = sums.setdefault((host, layout, token, parent), [0, 0, 0, 0, text, text])
                    held[0] += 1
                    held[1] += n
                    held[2] = max(held[2], n)
                    held[3] += xxh64_intdigest(b"%d %d" % (number, n)) >> 24
                    held[4], held[5] = min(held[4], text), max(held[5], text)
            yield pa.RecordBatch.from_pydict(
                {
                    **{
                        name: pa.array([key[k] for key in sums], pa.string())
                        for k, name in enumerate(("host", "layout", "token", "parent"))
                    },
                    **{
                        name: pa.array([v[k] for v in sums.values()], pa.int64())
                        for k, name in enumerate(("pages", "total", "most", "vector", "least_text", "most_text"))
                    },
                }
            )

    rows = pages.select("host", F.xxhash64("html").alias("number"), "html")
    counted = rows.mapInArrow(
        run,
        "host string, layout string, token string, parent string, pages long, total long, most long, vector long,"
        " least_text long, most_text long",
    )
    counted = materialise(
        counted.groupBy("host", "layout", "token", "parent").agg(
            F.sum("pages").alias("pages"),
            F.sum("total").alias("total"),
            F.max("most").alias("most"),
            F.sum("vector").alias("vector"),
            F.min("least_text").alias("least_text"),
            F.max("most_text").alias("most_text"),
        ),
        "occurrences",
    )
    whole = counted.where("token = ''").select(
        "host", "layout", F.col("pages").alias("of"), (F.col("least_text") != F.col("most_text")).alias("differ")
    )
    frequent = counted.where("token <> ''").join(whole, ["host", "layout"]).where(F.col("pages") > SUPPORT * F.col("of"))
    return frequent.select(
        "host",
        "layout",
        "token",
        "parent",
        "vector",
        ((F.col("most") == 1) & (F.col("total") == F.col("pages"))).alias("at_once"),
        (
            F.col("differ") & (F.col("pages") >= CONSTANT_FROM) & (F.col("least_text") == F.col("most_text"))
        ).alias("constant"),
    )


def nested(template: list[dict]) -> tuple[set[str], set[str]]:
    """(root tokens, tokens of valid classes): classes whose tokens nest in valid ones."""
    root = {t["token"] for t in template if t["at_once"]}
    classes: dict[int, list[dict]] = {}
    for token in template:
        if not token["at_once"]:
            classes.setdefault(token["vector"], []).append(token)
    valid = {t["token"] for t in template if t["at_once"] and (not t["parent"] or t["parent"] in root)}
    root &= valid
    while True:
        new = {
            t["token"]
            for members in classes.values()
            if all(t["parent"] in valid or any(t["parent"] == m["token"] for m in members) for t in members)
            for t in members
        } - valid
        if not new:
            return root, valid
        valid |= new


class Template:
    """The slots of a layout: those of its articles, and those whose text is constant."""

    def __init__(self, tokens: list[dict]):
        root, valid = nested(tokens)
        self.main = _articles(root) or _articles(valid)
        self.constant = {
            t["token"] for t in tokens if t["constant"] and t["token"] in valid and _tag(t["token"]) not in _HEADINGS
        }


def _tag(token: str) -> str:
    return token.rpartition("/")[2].partition(".")[0]


def _articles(tokens: set[str]) -> set[str]:
    return {t for t in tokens if _tag(t) in MAIN}


def main_blocks(page: str, template: Template) -> list[str]:
    """Blocks of the slots that belong to the main text."""
    # article slots, slots that vary, all slots outside furniture
    blocks: tuple[list[str], ...] = ([], [], [])
    run: tuple[list[str], ...] = ([], [], [])
    inside = False

    def finish() -> None:
        for parts, into in zip(run, blocks, strict=True):
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                into.append(text)
            parts.clear()

    for event in settled(page):
        kind, value, top, ends = event
        if kind == "tag":
            if ends:
                finish()
            if _opens(event):
                article = top.path in template.main if template.main else top.tag in MAIN
                top.main = article or bool(top.up and top.up.main)
                if top.tag == "br":
                    for parts in run:
                        parts.append(" ")
            continue
        if top and top.out:
            continue
        if top and top.main:
            inside = True
            run[0].append(value)
            continue
        run[2].append(value)
        if (top.slot if top else "") not in template.constant:
            run[1].append(value)
    finish()
    return blocks[0] if inside else blocks[1] or blocks[2]


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    host, _ = host_and_path(F.col("url").cast("string"))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
        host.alias("host"),
    )
    templates = host_templates(rows).groupBy("host", "layout").agg(
        F.collect_list(F.struct("token", "parent", "vector", "at_once", "constant")).alias("template")
    )

    def run(batches: Iterator):
        import pyarrow as pa

        known: dict[tuple, Template] = {}
        for batch in batches:
            texts = []
            for host, layout, page, template in zip(*(batch.column(k) for k in (2, 3, 4, 5)), strict=True):
                name = (host.as_py(), layout.as_py())
                if name not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[name] = Template(template.as_py() or [])
                texts.append("\n\n".join(main_blocks(page.as_py(), known[name])))
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column(0),
                    "url": batch.column(1),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    joined = with_layouts(rows).join(materialise(templates, "templates"), ["host", "layout"], "left")
    return joined.select("page_id", "url", "host", "layout", "html", "template").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
