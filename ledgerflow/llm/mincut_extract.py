"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks: runs of text between starts and ends of block elements, outside scripts,
styles and other elements without text of the page.  A logistic classifier gives each block a cost
for either label; the costs are capacities from the source (content) and to the sink (boilerplate).
Neighbours in page order are joined by an edge, as are a block and the next one of the same parent
element.  The minimum cut is the labelling of least cost: blocks on the source's side are the text.

The classifier is fitted to a bounded sample of pages (``sample_pages``).  Its labels come from
elements and names that say what they hold (article, nav, class="ad", ...): the nearest such ancestor
counts; of a body, main, article or heading only whole classes and roles do.  Weights are drawn towards a prior, which holds alone where a sample has no labels.

Blocks: character references are decoded, white space becomes one space, ends are trimmed; blocks of
the text are joined by an empty line in page order.

Defined results: a null or empty page and one without blocks gives an empty text.  Unclosed elements,
stray ends and a page cut off anywhere are read as far as they go.  Repeated rows get the same result.
The column ``out`` is replaced; other columns pass through.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbatch import strings

# HTML's block elements, elements without text of the page, and void elements.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option
p pre search section summary table tbody td tfoot th thead title tr ul""".split())
SILENT = frozenset("script style noscript template title textarea select svg iframe button datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A start of the first closes an open one of the second.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset(["table", "ul", "ol", "dl", "div", "article", "section", "body", "html", "nav", "aside", "form", "main",
                    "footer", "header"])

CONTENT_TAGS = frozenset(["article", "main"])
BOILER_TAGS = frozenset(["nav", "footer", "aside", "form", "menu", "dialog", "head"])
BOILER_NAMES = re.compile(r"""(?ix)(?<![a-z])(?:nav|navbar|navigation|menu|side-?bar|footer|masthead|site-?header|page-?header
|top-?bar|comments?|reply|replies|respond|disqus|promo|advert\w*|ads?|sponsor\w*|banner|cookies?|consent|notices?|alert
|share|sharing|social|related|recommend\w*|trending|popular|subscribe|newsletter|breadcrumbs?|pagination|pager|widget
|pop-?up|modal|overlay|legal|copyright|login|log-?in|sign-?up|register|search|skip|tags|toolbar|contentinfo|complementary
|rail|teaser|outbrain|taboola|paywall|toc|meta)(?![a-z])""")
CONTENT_NAMES = re.compile(r"(?ix)(?<![a-z])(?:article|article-?body|content|main|main-?content|post|post-?body|entry|story|body-?text)(?![a-z])")
# A page's or an article's own element, or a heading: only a whole class or role says what it is.
WHOLE = frozenset(["body", "main", "article", "h1", "h2", "h3", "h4", "h5", "h6"])
CONTAINERS = frozenset(["div", "section", "ul", "ol", "dl", "header", "details", "fieldset", "span"])
_HAS = re.compile(r"(?i)(?:no|not|has|with|without|hide)[-_]")  # with-sidebar is no sidebar
_NAMES = re.compile(r"""(?is)\b(class|id|role|itemprop|aria-label|data-component)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+|[^>]*)>""", re.S)

FEATURES = ["bias", "log_chars", "log_words", "link_share", "ends_sentence", "commas", "upper_share", "digit_share",
            "paragraph", "heading", "list_or_cell", "content_ancestor", "boiler_ancestor", "short"]
PRIOR = np.array([-1.0, 0.35, 0.35, -4.0, 1.0, 0.3, -0.5, -1.0, 0.8, 0.3, -0.5, 3.0, -6.0, -0.8])
NEXT_WEIGHT = 0.6        # edge between neighbours in page order
SIBLING_WEIGHT = 0.6     # edge between a block and the next one of the same parent
DEEPEST = 512            # elements open at once; text of deeper ones belongs to the deepest of them


# What names of boxes are made of besides (share-buttons, related-posts), fixed values.
FURNITURE = frozenset("""area article articles bar block box button buttons container entry footer form group header icons
inner items link links list message news panel post posts row section slot stories unit up wrap wrapper""".split())


def _is_furniture(name: str) -> bool:
    """Whether a whole name says boilerplate: one of the names, or made of them and of words for boxes."""
    parts = [p for p in re.split("[-_]+", name.lower()) if p]
    said = [BOILER_NAMES.fullmatch(p) is not None for p in parts]
    return BOILER_NAMES.fullmatch(name) is not None or any(said) and all(s or p in FURNITURE for s, p in zip(said, parts))


@dataclass(slots=True)
class Block:
    text: str
    parent: int              # number of the element around the block's own
    link_chars: int
    tag: str
    said: int                # 1: the nearest telling ancestor says content; -1: boilerplate; 0: none


def _said(tag: str, attributes: str, above: int) -> int:
    """What an element says of its text; ``above``: what those around it say."""
    if tag in BOILER_TAGS:
        return -1
    if "=" in attributes:
        names = [(k.lower(), w) for k, v in _NAMES.findall(attributes) for w in v.strip("\"'").split() if not _HAS.match(w)]
        if tag in WHOLE:
            tokens = [w for k, w in names if k in ("class", "role")]
            if tag != "body" and any(map(BOILER_NAMES.fullmatch, tokens)):  # a page's body holds its article
                return -1
            if any(map(CONTENT_NAMES.fullmatch, tokens)):
                return 1
        elif above > 0:
            # Within an article a part of a name may be about its subject (related-work, meta-analysis), and a paragraph's
            # or a table's name about its place (share): only a container's whole class, role or id says what it is.
            tokens = [w for k, w in names if k in ("class", "role", "id")]
            if tag in CONTAINERS and any(map(_is_furniture, tokens)):
                return -1
            if any(map(CONTENT_NAMES.fullmatch, tokens)):
                return 1
        elif names:
            words = " ".join(w for _, w in names)
            if BOILER_NAMES.search(words):
                return -1
            if CONTENT_NAMES.search(words):
                return 1
    return 1 if tag in CONTENT_TAGS else 0


def blocks_of(page: str) -> list[Block]:
    """The page's blocks in order."""
    found: list[Block] = []
    stack: list[tuple[str, int, int, bool]] = [("", 0, 0, True)]  # tag, what was said, number, block element
    parts: list[str] = []
    links, link_chars, number, pos, end = 0, 0, 0, 0, len(page)
    tags_end = page.rfind(">") + 1       # behind it no tag ends: a search there would look through all that is left

    def flush() -> None:
        nonlocal parts, link_chars
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                owner = [x for x in stack if x[3]]
                found.append(Block(text, owner[-2].__getitem__(2) if len(owner) > 1 else 0, min(link_chars, len(text)),
                                   owner[-1][0], stack[-1][1]))
            parts, link_chars = [], 0

    def pop_to(depth: int) -> None:
        nonlocal links
        for x in stack[depth:]:
            if x[0] == "a":
                links -= 1
        del stack[depth:]

    while pos < end:
        m = TOKEN.search(page, pos, tags_end) if pos < tags_end else None
        text = html.unescape(page[pos:m.start()] if m else page[pos:].partition("<!--")[0])
        if text:
            parts.append(text)
            if links:
                link_chars += len(text)
        if not m:
            break
        pos = m.end()
        if m[2] is None:
            if pos == tags_end and m[0].startswith("<!--") and not m[0].endswith("-->"):
                break       # an open comment takes the rest
            continue
        tag = m[2].lower()
        if tag == "br":
            parts.append(" ")
            continue
        if m[1]:
            if tag in BLOCK:
                flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    if any(x[3] for x in stack[depth:]):
                        flush()
                    pop_to(depth)
                    break
                if stack[depth][0] in SCOPES and tag not in BLOCK:
                    break  # a stray end of an inline element doesn't close blocks
            continue
        if tag in SILENT:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, pos) if not m[3].endswith("/") else None
            if tag in BLOCK or tag in ("button", "select", "textarea"):
                flush()
            if not m[3].endswith("/"):
                pos = close.start() if close else end
            continue
        if tag in BLOCK:
            flush()
            if tag != "p" or stack[-1][0] != "":
                for depth in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                    if stack[depth][0] == "p":
                        pop_to(depth)
                        break
                    if stack[depth][0] in SCOPES:
                        break
            if tag in CLOSES:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in CLOSES[tag]:
                        pop_to(depth)
                        break
                    if stack[depth][0] in SCOPES:
                        break
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        if len(stack) > DEEPEST:
            continue
        number += 1
        stack.append((tag, _said(tag, m[3], stack[-1][1]) or stack[-1][1], number, tag in BLOCK))
        if tag == "a":
            links += 1
    flush()
    return found


def features(blocks: list[Block]) -> np.ndarray:
    rows = []
    for b in blocks:
        t, n = b.text, len(b.text)
        words = t.count(" ") + 1
        letters = max(1, sum(map(t.count, "aeiounrst"))) if n < 400 else 0
        upper = 0.0 if n >= 400 else min(1.0, sum(map(str.isupper, t)) / letters)
        digits = 0.0 if n >= 400 else sum(map(str.isdigit, t)) / n
        rows.append((1.0, np.log1p(n) - 4, np.log1p(words) - 2.5, b.link_chars / n, t[-1] in ".!?…\"”»", min(1.0, t.count(",") / 3),
                     upper, digits, b.tag in ("p", "blockquote", "pre"), len(b.tag) == 2 and b.tag[0] == "h" and b.tag[1].isdigit(),
                     b.tag in ("li", "td", "th", "dt", "dd", "option") and b.said <= 0, b.said > 0, b.said < 0, words < 4 and b.said <= 0))
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


def train(x: np.ndarray, y: np.ndarray, rounds: int = 25, pull: float = 0.02) -> np.ndarray:
    """Logistic regression by Newton steps, with a pull towards the prior."""
    w = PRIOR.copy()
    if not len(y):
        return w
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))  # both labels weigh the same
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (p - (y > 0))) + pull * (w - PRIOR)
        hess = (x * (share * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    out = [(i, i + 1, NEXT_WEIGHT) for i in range(len(blocks) - 1)]
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        j = last.get(b.parent)
        if j is not None:
            out.append((j, i, SIBLING_WEIGHT))
        last[b.parent] = i
    return out


def min_cut(score: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut; nodes that no flow decides are not.

    Positive scores are capacities from the source, negative ones to the sink.  A node whose score
    outweighs all its edges is on its score's side in every minimum cut: it is taken out, and its edges
    become scores of its neighbours.  Max-flow by shortest augmenting paths settles the rest.
    """
    n = len(score)
    score, near = list(score), [[] for _ in range(n)]
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
    side: list[bool | None] = [None] * n
    load = [sum(w for _, w in x) for x in near]
    queue = list(range(n))
    while queue:
        i = queue.pop()
        if side[i] is not None or abs(score[i]) <= load[i] or score[i] == 0:
            continue
        side[i] = score[i] > 0
        for j, w in near[i]:
            if side[j] is None:
                score[j] += w if side[i] else -w
                load[j] -= w
                queue.append(j)
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        source, sink = n, n + 1
        room: list[dict[int, float]] = [{} for _ in range(n + 2)]
        for i in rest:
            for j, w in near[i]:
                if side[j] is None:
                    room[i][j] = room[i].get(j, 0.0) + w
            if score[i] > 0:
                room[source][i], room[i][source] = score[i], 0.0
            else:
                room[i][sink], room[sink][i] = -score[i], 0.0
        for reached in _augment(room, source, sink):
            pass
        for i in rest:
            side[i] = i in reached
    return [bool(s) for s in side]


def _augment(room: list[dict[int, float]], source: int, sink: int) -> Iterator[set[int]]:
    """Phases of Dinic's algorithm; each gives the nodes that the source still reaches."""
    while True:
        level, queue = {source: 0}, [source]
        for u in queue:
            for v, c in room[u].items():
                if c > 1e-12 and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        yield set(level)
        if sink not in level:
            return
        arcs = {u: iter(list(room[u])) for u in level}
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                flow = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= flow
                    room[b][a] = room[b].get(a, 0.0) + flow
                full = next(k for k, (a, b) in enumerate(zip(path, path[1:])) if room[a][b] <= 1e-12)
                del path[full + 1:]
                continue
            for v in arcs[u]:
                if room[u].get(v, 0.0) > 1e-12 and level.get(v) == level[u] + 1:
                    path.append(v)
                    break
            else:
                path.pop()
                level[u] = -1


def main_text(page: str, weights: np.ndarray) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    side = min_cut((features(blocks) @ weights).tolist(), edges_of(blocks))
    return "\n\n".join(b.text for b, content in zip(blocks, side) if content)


def fit(pages: DataFrame, html_col: str = "html", sample_pages: int = 2000) -> np.ndarray:
    """Weights from the labelled blocks of about ``sample_pages`` pages, taken by a hash of the page."""
    rows = pages.count()
    width = len(FEATURES)

    @F.pandas_udf("array<array<float>>")
    def labelled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            out = []
            for page in strings(column):
                told = [b for b in blocks_of(page) if b.said]
                x = np.column_stack([features(told), [b.said for b in told]]) if told else np.zeros((0, width + 1))
                out.append(x.astype(np.float32).tolist())
            yield pd.Series(out)

    share = max(1, rows // sample_pages)
    sample = (pages.select(F.col(html_col).cast("string").alias("page")).where(F.col("page").isNotNull())
              .where(F.pmod(F.xxhash64("page"), F.lit(share)) == 0)
              .withColumn("h", F.xxhash64("page", F.lit(1))).orderBy("h", "page").limit(2 * sample_pages))
    data = [b for r in sample.select(labelled("page").alias("b")).collect() for b in r.b]
    table = np.array(data, np.float64).reshape(-1, width + 1)
    return train(table[:, :width], table[:, width])


def extract(pages: DataFrame, weights: np.ndarray, html_col: str = "html", out: str = "text") -> DataFrame:
    """All rows with the string column ``out``."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            yield pd.Series([main_text(page, weights) for page in strings(column)], dtype=object)

    return pages.withColumn(out, text(F.col(html_col).cast("string")))
