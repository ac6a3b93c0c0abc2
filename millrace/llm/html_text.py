"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags. A word scores by what it stands in, a tag scores negative; a
linear scan finds the contiguous run of the largest sum, which is the content region. Weights are
log-odds counted over labelled pages: those whose author marked the article with `<article>`, `<main>`
or the microdata property `articleBody`. Boilerplate inside the region, such as an advert between two
paragraphs, scores negative by itself and is left out of the text.

A word stands in the nearest element that says what it is for: by its tag (`nav`, `footer`, ...), its
role, or a word of its class or id (`menu`, `sidebar`, ...); an element that is content by its tag,
and blocks inside it, only say something else by a whole name (`sidebar`, not `has-sidebar`). Elements that say
nothing are passed over, and where none says anything its block's tag counts. The lists of such names only
give the counts that weights start from; labelled pages overrule them.

Defined results: null and empty html give an empty text; tags that are never closed and pages that
break off are read as far as they go; a page without any word that scores positive has no text;
nothing is cut from long pages; repeated rows get one text; other columns are kept, but one named like the
result is replaced.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .chars import add_columns

# Fixed values of HTML: elements whose content is no text, and elements that end a block of text.
RAW = ("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp")
HIDDEN = {"head", "template", "noscript", "svg", "math", "canvas", "object", "audio", "video", "select", "button", "datalist", "map"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul caption".split()
)
CLOSES_P = BLOCKS - {"body", "html"}

# What an element is for, by its tag or a word of its role, class or id.
PURPOSE_OF_TAG = {
    "article": "content", "main": "content", "nav": "menu", "menu": "menu", "header": "header", "footer": "footer",
    "aside": "sidebar", "form": "form", "fieldset": "form", "dialog": "notice", "search": "form",
}
PURPOSE_OF_WORD = {
    word: purpose
    for purpose, words in {
        "content": "article articlebody content post entry story main maincontent body text",
        "menu": "nav navigation navbar menu menubar breadcrumb breadcrumbs pagination pager tabs toc tablist directory skip",
        "header": "header masthead banner topbar branding logo hero contentinfo-top",
        "footer": "footer foot colophon copyright contentinfo legal bottom imprint",
        "sidebar": "sidebar aside rail complementary widget widgets related recommended recommendations trending popular "
        "teaser teasers tags tagcloud byline author share sharing social newsletter promo outbrain taboola",
        "notice": "cookie cookies consent gdpr notice alert warning banner-notice popup modal overlay dialog toast paywall "
        "subscribe subscription announcement disclaimer notification",
        "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors dfp adsense adbox adslot",
        "form": "form search searchbox login signup signin register captcha",
        "comments": "comment comments commentlist respond reply replies disqus discussion guestbook reactions",
    }.items()
    for word in words.split()
}
BOILERPLATE = ("menu", "header", "footer", "sidebar", "notice", "advert", "form", "comments")
# Counts every weight starts from, as (in content, outside), so that purposes no labelled page has keep a sense.
PRIOR = {"content": (20.0, 1.0), **{p: (0.05, 20.0) for p in BOILERPLATE}}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>\x00]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
WORD_PARTS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def purpose(tag: str, attrs: str, inside: bool = False) -> str | None:
    """What an element is for, or null if it says nothing. Attributes count by their exact name. Inside a
    marked article only whole names count, and only those of a block: a paragraph with the class
    `share-price` or a link with the class `search` is text like its neighbours."""
    by_tag = PURPOSE_OF_TAG.get(tag)
    if not attrs or tag in ("html", "body"):
        return by_tag
    found, whole = set(), set()  # purposes of parts of names, and of whole names
    for name, *values in ATTRIBUTE.findall(attrs):
        name = name.lower()
        value = "".join(values)
        if name == "hidden" and value.lower() != "until-found" or name == "aria-hidden" and value.lower() == "true":
            return "hidden"
        if name == "itemprop":
            whole |= {"content"} if "articleBody" in value.split() else set()
        elif name in ("class", "id", "role"):
            if name != "id":
                whole |= {PURPOSE_OF_WORD.get(w) for w in value.lower().split()}
            elif value.lower() in PURPOSE_OF_WORD:
                whole.add(PURPOSE_OF_WORD[value.lower()])
            found |= {PURPOSE_OF_WORD.get(w) for w in WORD_PARTS.findall(CAMEL.sub(" ", value).lower())}
    # What is content by its tag or a whole name is not made boilerplate by a part, as of has-sidebar.
    if by_tag == "content":
        found = whole | {"content"}
    elif inside:
        found = whole if tag in BLOCKS else set()
    else:
        found = whole | {"content"} if "content" in whole else found | whole
    if {"header", "content"} <= found:  # the head of an article
        found -= {"header"}
    for kind in ("comments", "advert", "notice", "menu", "footer", "form", "sidebar", "header"):
        if kind in found:
            return kind
    return by_tag or ("content" if "content" in found else None)


def labelled(tag: str, attrs: str) -> bool:
    if tag in ("article", "main") or "articleBody" not in attrs:
        return tag in ("article", "main")
    return any(name.lower() == "itemprop" and "articleBody" in "".join(v).split() for name, *v in ATTRIBUTE.findall(attrs))


def tokens(page: str) -> Iterator[tuple]:
    """`("tag", name, inside article)` and `("text", key, inside article, block number, text)` in page
    order. A key is a purpose, or the tag of the block. Text outside of any block starts one."""
    stack: list[tuple] = []  # (tag, purpose, hidden, comments, labelled)
    block, at, n = 0, 0, len(page)

    def context() -> tuple:
        for tag, why, *_ in reversed(stack):
            if why:
                return why
        return next((t for t, *_ in reversed(stack) if t in BLOCKS), "body")

    while at < n:
        m = TOKEN.search(page, at)
        start = m.start() if m else n
        if start > at and not (stack and stack[-1][2]):
            text = page[at:start]
            if text.strip():
                key = "comments" if stack and stack[-1][3] else context()
                yield "text", key, bool(stack and stack[-1][4]), block, text
            else:
                yield "space", None, False, block, text
        if not m:
            return
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            block += 1
        if not m["end"]:
            attrs = m["attrs"] or ""
            if tag in CLOSES_P and any(s[0] == "p" for s in stack):
                _close(stack, "p")
            if tag in ("li", "dt", "dd", "option", "tr", "td", "th") and stack and stack[-1][0] == tag:
                stack.pop()
            last = stack[-1] if stack else (None, None, False, False, False)
            why = purpose(tag, attrs, last[4])
            entry = (tag, why, last[2] or tag in HIDDEN or why == "hidden", last[3] or why == "comments", last[4] or labelled(tag, attrs))
            if tag in RAW:
                end = RAW_END[tag].search(page, at)
                at = end.start() if end else n
            elif tag not in VOID:  # a slash at the end closes nothing in HTML
                stack.append(entry)
        elif tag not in VOID:
            _close(stack, tag)
        hidden = bool(stack and stack[-1][2])
        if tag == "br" and not hidden:
            yield "space", None, False, block, " "
        if not hidden:
            yield "tag", tag, bool(stack and stack[-1][4])


def _close(stack: list, tag: str) -> None:
    """Close the nearest open element of a name, and what is open in it; a stray end is ignored."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == tag:
            del stack[i:]
            return


Weights = dict[str, float]


def learn(pages: DataFrame, column: str = "html") -> Weights:
    """Weights counted over all labelled pages. Tasks add up their pages; keys are tags and purposes of
    a fixed list, so what reaches the driver is a short table."""
    known = BLOCKS | VOID | set(PURPOSE_OF_TAG.values()) | set(BOILERPLATE) | {"content", "hidden", "a", "b", "i", "em", "strong", "span", "u", "code", "label"}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for value in batch.column(0):
                found = list(tokens(value.as_py() or ""))
                if not any(t[2] for t in found if t[0] == "text"):
                    continue
                for kind, key, within, *rest in found:
                    if kind == "space" or key not in known:
                        continue
                    (inside if within else outside)[f"{kind} {key}"] += len(rest[1].split()) if rest else 1
        keys = sorted(inside | outside)
        columns = [pa.array(keys, pa.string()), *[pa.array([c[k] for k in keys], pa.int64()) for c in (inside, outside)]]
        yield pa.RecordBatch.from_arrays(columns, names=["k", "i", "o"])

    counted = pages.select(column).mapInArrow(work, "k string, i long, o long")
    rows = counted.groupBy("k").agg(F.sum("i").alias("i"), F.sum("o").alias("o")).collect()
    return weights_of({r["k"]: (r["i"], r["o"]) for r in rows})


def weights_of(counts: dict[str, tuple[int, int]]) -> Weights:
    """Log-odds of standing inside the article, between -4 and 4, from the counts of labelled pages and
    what every weight starts from. Tags always cost."""
    out: Weights = {}
    for key in {*counts, *[f"text {p}" for p in PRIOR]}:
        kind, name = key.split(" ", 1)
        i, o = counts.get(key, (0, 0))
        more, less = PRIOR.get(name, (4.0, 1.0) if kind == "text" else (1.0, 1.0))
        odds = math.log((i + more) / (o + less))
        out[key] = -min(4.0, max(0.1, 1.0 - odds / 2)) if kind == "tag" else max(-4.0, min(4.0, odds))
    return out


def main_text(page: str | None, weights: Weights) -> str:
    """The blocks of the content region, one a line."""
    found = list(tokens(page or ""))
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    scores = []
    for at, (kind, key, *rest) in enumerate(found):
        if kind == "text":
            each = weights.get(f"text {key}", 1.0)
            value = each * len(rest[2].split())
        else:
            each = value = 0.0 if kind == "space" else weights.get(f"tag {key}", -0.5)
        scores.append(each)
        if total <= 0:
            total, start = 0.0, at
        total += value
        if total > best:
            best, best_at = total, (start, at + 1)
    blocks: dict[int, list[str]] = {}
    for each, (kind, key, *rest) in zip(scores[slice(*best_at)], found[slice(*best_at)]):
        if kind == "space" or kind == "text" and each > 0:
            blocks.setdefault(rest[1], []).append(html.unescape(rest[2]))
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, weights: Weights, column: str = "html", out: str = "text") -> DataFrame:
    """`pages` with the main text of each."""

    def compute(columns: dict[str, pa.Array]) -> list[pa.Array]:
        return [pa.array([main_text(v.as_py(), weights) for v in columns[column]], pa.string())]

    return add_columns(pages, [T.StructField(out, T.StringType())], compute, [column], column)
