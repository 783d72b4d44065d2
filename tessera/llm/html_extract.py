"""Main text of web pages by equivalence classes of template tokens.

A page is a sequence of tokens: tags (name and class) and text nodes. The
occurrence vector of a token says on which pages of its host it stands exactly
once; it is kept as a count and an exclusive-or of page hashes, so that tokens
meet in a grouped sum and no host's pages meet in a task. Tokens of equal vector
form a class; that of the host's pages is the root class, others belong to the
templates of parts of the host's pages. Large and frequent classes are valid if
their tokens stand in the same order on every page and if any two of them are
nested: one stands inside the same gap of the other on every page with both; of
two that are not, the one on fewer pages goes. The root class and the valid ones
are the template. Sectioning tags on at least half of the pages nest by depth; the
deepest that holds nearly all free text opens the main slot (an article or main
element if the template has one that holds most text of its pages), and all text
nodes inside the slot are the text. Pages that have none of them take the deepest
tag of a valid class that holds nearly all free text of its own pages. On pages
without a slot (or where it is the whole body) text nodes of the template before
and after the page's own text are template text, where the host has another page
and the page's own text is the larger part.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
comments are left out by element and by class name, from their start to where HTML
ends them, also without an end tag.

Defined results: a null or empty page has an empty text; a page without a url
belongs to the empty host; repeated rows get the same result each; truncated
pages end where they end; an empty table gives an empty table.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.cut import written

#: Share of the free text that the main slot holds at least.
MOST = 0.9
#: Share of the free text of its pages that an article or main element needs to be the main slot.
LARGE = 0.5
#: Tokens that a class needs, and the share of the host's pages that it stands on, to be checked as a template of a part of them.
SIZE = 3
FREQUENT = 0.25

# Element names by their role in HTML.
SKIPPED = frozenset(
    "head nav header footer aside form button select option textarea iframe object svg canvas dialog template noscript".split()
)
SECTIONS = frozenset("article main section div td body".split())
BLOCKS = frozenset(
    "address article blockquote body br caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr"
    " html li main ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Parts of class and id names of what is not main text.
UNWANTED = frozenset(
    "ad ads advert advertisement sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs sidebar aside"
    " header footer cookie cookies consent notice notices popup modal newsletter subscribe share sharing social"
    " comment comments disqus related recommended".split()
)

#: Name parts that tell of something elsewhere on the page (``has-sidebar``).
ELSEWHERE = frozenset("has no with without is hide show".split())
#: Name parts of the article itself: with one of them, a ``header`` holds the article's heading.
ARTICLE = frozenset("article post entry story content".split())

# Where elements end without an end tag (HTML's optional tags), and what keeps a tag from ending one further out.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KEPT = frozenset("html body article main".split())
#: Elements of unwanted classes inside each other that are told apart.
NESTED = 64
FOREIGN = frozenset("svg math".split())
RAW = frozenset("textarea iframe".split())
HEAD_PARTS = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
SCOPE = frozenset("caption td th table template object html".split())
SPECIAL = BLOCKS | SKIPPED | frozenset("center colgroup dir hgroup listing marquee menu optgroup search".split())
_TABLE, _LIST = frozenset(["table", "template"]), SPECIAL - {"address", "div", "p"}
_ROWS, _PARTS = frozenset("tr caption colgroup".split()), frozenset("tbody thead tfoot".split())
_P = frozenset("p"), SCOPE | {"button"}
IMPLIED = {
    **{n: [_P] for n in SPECIAL - {"body", "br", "button", "caption", "canvas", "colgroup", "head", "html", "iframe", "noscript",
       "object", "optgroup", "option", "select", "svg", "tbody", "td", "template", "textarea", "tfoot", "th", "thead", "title",
       "tr"}},
    "body": [(frozenset(["head"]), frozenset())],
    "li": [(frozenset(["li"]), _LIST - {"li"}), _P],
    **{n: [(frozenset(["dd", "dt"]), _LIST - {"dd", "dt"}), _P] for n in ("dd", "dt")},
    **{n: [(frozenset(["td", "th"]), _TABLE)] for n in ("td", "th")},
    "tr": [(_ROWS, _TABLE)],
    **{n: [(_PARTS, _TABLE), (_ROWS, _TABLE)] for n in _PARTS},
    "option": [(frozenset(["option"]), SPECIAL - {"option"})],
    "optgroup": [(frozenset(["option", "optgroup"]), SPECIAL - {"option", "optgroup"})],
    "button": [(frozenset(["button"]), SCOPE)],
}
BOUNDS = {
    **{n: frozenset() for n in ("table", "body", "html", "head")},
    **{n: _TABLE for n in ("td", "th", "tr", "caption", "colgroup", *_PARTS)},
    "p": SCOPE | {"button"},
    "li": SCOPE | {"ol", "ul"},
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)",
    re.S | re.I,
)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def host(url: str | None) -> str:
    """What stands between the first ``://`` and the path, with A-Z in lower case."""
    found = re.match(r"(?s).*?://([^/?#]*)", url or "")
    return found.group(1).translate(LOWER) if found else ""


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """``(kind, name, text)``: kinds ``open``, ``close`` and ``text``; a tag's text is its class and id names."""
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "text", "", page[at : m.start()]
        at = m.end()
        name = m.group(3)
        if name:
            names = " ".join(filter(None, (x for g in _NAMES.findall(m.group(4)) for x in g))) if m.group(4) else ""
            yield ("close" if m.group(2) else "open"), name.lower(), names.lower()
            if name.lower() in FOREIGN and m.group(4).endswith("/"):
                yield "close", name.lower(), ""
    if at < len(page):
        yield "text", "", page[at:]


@lru_cache(maxsize=4096)
def _unwanted(names: str) -> bool:
    """Whether a part of a class or id is an unwanted name that tells of the element itself."""
    for name in names.split():
        parts = set(re.split("[_-]+", name))
        found = parts & UNWANTED
        if found and not parts & ELSEWHERE and not (found == {"header"} and parts & ARTICLE):
            return True
    return False


def free_text(page: str) -> list[tuple[str, str, str, tuple[str, ...]]]:
    """The tokens outside of unwanted elements: ``(kind, name, text, sections)``.

    ``sections`` are the keys of the open sectioning tags, the outermost first.
    Elements end where HTML ends them: at their end tag, at a tag that implies it
    and at their parent's end. An element of an unwanted class that is an article
    or main element, or that holds most of the page's text, is not left out.
    """
    found: list[tuple] = []
    chars: dict[int, int] = {}
    total = 0
    # Open elements with what held outside of them: the sections, whether they are
    # skipped by name, and the marks of the elements of unwanted classes around.
    stack: list[tuple[str, tuple, bool, tuple]] = []
    opened: dict[str, int] = {}
    raw, sections, hidden, marks = "", (), False, ()

    def last(names: frozenset[str], bounds: frozenset[str]) -> int:
        """Where the last open element of these names stands, or -1 if there is none above a bound."""
        for n in names:
            if opened.get(n):
                break
        else:
            return -1
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in bounds:
                break
        return -1

    def end(at: int) -> None:
        """End the element at a place and all in it."""
        nonlocal sections, hidden, marks
        if at >= 0:
            _, sections, hidden, marks = stack[at]
            for e in stack[at:]:
                opened[e[0]] -= 1
            del stack[at:]

    def end_inline(at: int) -> None:
        """End an inline element, but not the blocks in it."""
        nonlocal marks
        if at >= 0:
            inner = stack[at + 1][3] if at + 1 < len(stack) else marks
            own = set(inner) - set(stack[at][3])
            opened[stack.pop(at)[0]] -= 1
            if own:
                stack[at:] = [(*e[:3], tuple(m for m in e[3] if m not in own)) for e in stack[at:]]
                marks = tuple(m for m in marks if m not in own)

    for kind, name, text in tokens(page):
        if raw and not (kind == "close" and name == raw):
            continue
        raw = ""
        top = stack[-1][0] if stack else ""
        if kind == "close":
            if name not in SPECIAL:
                end_inline(last(frozenset([name]), SCOPE))
            else:
                end(last(HEADINGS if name in HEADINGS else frozenset([name]), BOUNDS.get(name, SCOPE)))
        elif top == "head" and (name not in HEAD_PARTS if name else not text.isspace()):
            end(len(stack) - 1)
        if kind == "open":
            for names, bounds in IMPLIED.get(name, ()):
                end(last(names, bounds))
            if name == "a":
                end_inline(last(frozenset("a"), SCOPE))
            elif name in HEADINGS and stack and stack[-1][0] in HEADINGS:
                end(len(stack) - 1)
        if kind == "open" and name not in VOID:
            if name in ("html", "body") and opened.get(name):
                continue
            stack.append((name, sections, hidden, marks))
            opened[name] = opened.get(name, 0) + 1
            if name in SKIPPED:
                hidden = True
                if name in RAW:
                    raw = name
            elif text and not hidden and name not in KEPT and len(marks) < NESTED and _unwanted(text):
                marks += (len(chars),)
                chars[marks[-1]] = 0
            if name in SECTIONS:
                sections += (f"{name} {text}".strip(),)
        if hidden:
            continue
        found.append((kind, name, text, sections, marks))
        if kind == "text":
            held = len(text.strip())
            total += held
            for m in marks:
                chars[m] += held
    left_out = {m for m, n in chars.items() if 2 * n <= total}
    return [t[:4] for t in found if not left_out or left_out.isdisjoint(t[4])]


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def occurrences(pages: DataFrame) -> DataFrame:
    """``host, kind, token, depth, pages, vector, chars, page_chars`` summed over all pages.

    Kinds: ``page`` (one token that stands on every page), ``tag`` (sections) and
    ``text`` (text nodes). Only tokens that a page has exactly once count for it.
    ``chars`` is the free text inside a section, ``page_chars`` that of the pages with it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("host", pa.string()), ("kind", pa.string()), ("token", pa.string()), ("depth", pa.int64()),
             ("pages", pa.int64()), ("vector", pa.int64()), ("chars", pa.int64()), ("page_chars", pa.int64())]
        )
        sums: dict[tuple, list[int]] = {}

        def table() -> pa.RecordBatch:
            rows = [(*key[:3], v[3], *v[:3], v[4]) for key, v in sums.items()]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html")):
                own, page = host(url), page.as_py() or ""
                number = _hash(f"{url}\n{page}")
                seen: dict[tuple[str, str], int] = {}
                inside: dict[str, int] = {}
                depths: dict[str, int] = {}
                total = 0
                for kind, name, text, sections in free_text(page):
                    if kind == "open" and name in SECTIONS:
                        seen["tag", sections[-1]] = seen.get(("tag", sections[-1]), 0) + 1
                        depths[sections[-1]] = len(sections)
                    elif kind == "text" and (text := text.strip()):
                        key = "text", f"{_hash(text):x}"
                        seen[key] = seen.get(key, 0) + 1
                        total += len(text)
                        for s in sections:
                            inside[s] = inside.get(s, 0) + len(text)
                seen["page", ""] = 1
                for (kind, token), n in seen.items():
                    if n == 1:
                        sum_of = sums.setdefault((own, kind, token), [0, 0, 0, 0, 0])
                        sum_of[0] += 1
                        sum_of[1] ^= number
                        sum_of[2] += total if kind == "page" else inside.get(token, 0)
                        sum_of[3] = max(sum_of[3], depths.get(token, 0))
                        sum_of[4] += total if kind == "tag" else 0
            if len(sums) > 100_000:
                yield table()
        if sums:
            yield table()

    kept = pages.select("url", "html").mapInArrow(
        run, "host string, kind string, token string, depth long, pages long, vector long, chars long, page_chars long"
    )
    return kept.groupBy("host", "kind", "token").agg(
        F.max("depth").alias("depth"),
        F.sum("pages").alias("pages"),
        F.bit_xor("vector").alias("vector"),
        F.sum("chars").alias("chars"),
        F.sum("page_chars").alias("page_chars"),
    )


CLASS = ["host", "pages", "vector"]


def classes(found: DataFrame) -> DataFrame:
    """``host, pages, vector, tokens``: the large and frequent classes of a host's tokens, unchecked."""
    root = found.where("kind = 'page'").select("host", F.col("pages").alias("all_pages"))
    tokens_of = found.where("kind <> 'page' AND pages > 1").join(root, "host")
    frequent = tokens_of.where(F.col("pages") >= FREQUENT * F.col("all_pages"))
    members = F.sort_array(F.collect_list(F.struct("kind", "token")))
    return frequent.groupBy(*CLASS).agg(members.alias("tokens")).where(F.size("tokens") >= SIZE)


def _places(page: str, known: dict[tuple[str, str], int]) -> dict[int, list[tuple[int, str]]]:
    """Per class, where its tokens stand that the page has exactly once, in page order."""
    at: dict[tuple[str, str], list[int]] = {}
    for i, (kind, name, text, sections) in enumerate(free_text(page)):
        if kind == "open" and name in SECTIONS:
            at.setdefault(("tag", sections[-1]), []).append(i)
        elif kind == "text" and (text := text.strip()):
            at.setdefault(("text", f"{_hash(text):x}"), []).append(i)
    places: dict[int, list[tuple[int, str]]] = {}
    for key, found in at.items():
        if len(found) == 1 and key in known:
            places.setdefault(known[key], []).append((found[0], f"{key[0]} {key[1]}"))
    return {c: sorted(p) for c, p in places.items()}


def valid_classes(rows: DataFrame, made: DataFrame) -> DataFrame:
    """``host, pages, vector`` of the classes that are ordered and nested, from ``rows`` with ``host`` and ``html``."""
    listed = made.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("pages", "vector", "tokens"))).alias("classes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("host", pa.string()), *[(c, pa.int64()) for c in ("outer", "inner", "least", "most")]])
        for batch in batches:
            tables: dict[str, dict[tuple[str, str], int]] = {}
            seen: dict[tuple[str, int, int], tuple[int, int]] = {}
            for own, page, of in zip(batch.column("host").to_pylist(), batch.column("html"), batch.column("classes")):
                if own not in tables:
                    tables[own] = {(t["kind"], t["token"]): c for c, x in enumerate(of.as_py()) for t in x["tokens"]}
                places = _places(page.as_py() or "", tables[own])
                for a, outer in places.items():
                    spots = [i for i, _ in outer]
                    for b, inner in places.items():
                        if a == b:
                            value = _hash("\n".join(t for _, t in outer))
                        else:
                            value = bisect(spots, inner[0][0])
                            value = value if bisect(spots, inner[-1][0]) == value else -1
                        low, high = seen.get((own, a, b), (value, value))
                        seen[own, a, b] = min(low, value), max(high, value)
            if seen:
                made_of = zip(*[(*key, *value) for key, value in seen.items()])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made_of, schema)], schema=schema)

    checked = (
        rows.join(listed, "host")
        .select("host", "html", "classes")
        .mapInArrow(run, "host string, outer long, inner long, least long, most long")
        .groupBy("host", "outer", "inner")
        .agg(F.min("least").alias("least"), F.max("most").alias("most"))
    )
    # A pair is nested if either stands in one gap of the other, the same on all pages with both.
    one = (F.col("least") == F.col("most")) & ((F.col("least") >= 0) | (F.col("outer") == F.col("inner")))
    ends = [F.least("outer", "inner").alias("less"), F.greatest("outer", "inner").alias("greater")]
    judged = checked.groupBy("host", *ends).agg(F.max(one).alias("nested")).where(~F.col("nested"))
    # Numbers follow the pages of a class, so the one on fewer pages goes.
    wrong = judged.select("host", F.col("less").cast("int").alias("number")).distinct()
    numbered = listed.select("host", F.posexplode("classes").alias("number", "c")).select("host", "number", "c.pages", "c.vector")
    return numbered.join(wrong, ["host", "number"], "left_anti").select(*CLASS)


def templates(found: DataFrame, valid: DataFrame) -> DataFrame:
    """``host, slots, texts``: main slots of a host, the best first, and its template text nodes."""
    root = found.where("kind = 'page'").select(
        "host", F.col("pages").alias("all_pages"), F.col("vector").alias("root"), F.col("chars").alias("all_chars")
    )
    tokens_of = found.where("kind <> 'page' AND pages > 1 OR kind = 'tag'").join(root, "host")
    tokens_of = tokens_of.join(valid.withColumn("valid", F.lit(True)), CLASS, "left")
    in_class = F.col("valid").isNotNull()
    half = 2 * F.col("pages") >= F.col("all_pages")
    semantic = half & F.col("token").rlike(r"^(article|main)( |$)") & (F.col("chars") >= LARGE * F.col("page_chars"))
    common = half & (F.col("chars") >= MOST * F.col("all_chars"))
    own = in_class & (F.col("chars") >= MOST * F.col("page_chars"))
    slot = (F.col("kind") == "tag") & (semantic | common | own)
    whole = (F.col("pages") == F.col("all_pages")) & (F.col("vector") == F.col("root")) & (F.col("all_pages") > 1)
    fixed = (F.col("kind") == "text") & (whole | in_class)
    # Semantic slots come first, the outermost of them; of others the deepest, those of parts of the pages last.
    better = F.struct(
        F.when(semantic, 0).when(common, 1).otherwise(2).alias("rank"),
        F.when(semantic, F.col("depth")).otherwise(-F.col("depth")).alias("depth"),
        "token",
    )
    return tokens_of.where(slot | fixed).groupBy("host").agg(
        F.transform(F.array_sort(F.collect_set(F.when(slot, better))), lambda s: s["token"]).alias("slots"),
        F.collect_set(F.when(fixed, F.col("token"))).alias("texts"),
    )


def main_text(page: str | None, slots: list[str], texts: frozenset[str]) -> str:
    """The slots' text of one page: blocks with single blanks, joined by one blank."""
    found = list(free_text(page or ""))
    opened = {s for kind, name, _, sections in found if kind == "open" and name in SECTIONS for s in sections[-1:]}
    slot = next((s for s in slots if s in opened), None)
    kept = range(len(found))
    if texts and (slot is None or slot.split()[0] == "body"):
        held = [i for i in kept if found[i][0] == "text" and found[i][2].strip()]
        own = [i for i in held if f"{_hash(found[i][2].strip()):x}" not in texts]
        if own:
            inside = range(own[0], own[-1] + 1)
            edges = sum(len(found[i][2].strip()) for i in held if i not in inside)
            if sum(len(found[i][2].strip()) for i in own) >= edges:
                kept = inside
    parts: list[str] = []
    for i in kept:
        kind, name, text, sections = found[i]
        if kind != "text":
            if name in BLOCKS:
                parts.append(" ")
        elif slot is None or slot in sections:
            parts.append(entities.unescape(text))
    return " ".join("".join(parts).split())


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``page`` (the row without its html) and ``text`` for every page."""
    others = [F.col(f"`{c}`") for c in pages.columns if c != html]
    rows = pages.select(F.struct(*others).alias("page"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    found = F.regexp_extract("url", r"(?s)\A.*?://([^/?#]*)", 1)
    own = F.coalesce(F.translate(found, UPPER, UPPER.lower()), F.lit(""))
    rows = rows.withColumn("host", own)
    seen = written(occurrences(rows), "page-tokens")
    valid = written(valid_classes(rows, written(classes(seen), "page-classes")), "page-classes")
    known = written(templates(seen, valid), "page-templates")
    # The template table is written, so Spark knows its size: it sends it to all tasks
    # if small, else deals both sides by host and splits hosts that are too large.
    joined = rows.join(known, "host", "left").select("page", "html", "slots", "texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[tuple, frozenset[str]] = {}
            made = []
            for page, slots, texts in zip(
                batch.column("html"), batch.column("slots").to_pylist(), batch.column("texts").to_pylist()
            ):
                key = tuple(texts or ())
                made.append(main_text(page.as_py(), slots or [], sets.setdefault(key, frozenset(key))))
            yield pa.RecordBatch.from_arrays([batch.column("page"), pa.array(made, pa.string())], ["page", "text"])

    schema = T.StructType([joined.schema["page"], T.StructField("text", T.StringType())])
    return joined.mapInArrow(run, schema)
