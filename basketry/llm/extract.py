"""Main text of web pages by consensus host paths.

Each page is read into text blocks with the generalised tag-class path they stand in, without
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments.  Its containers are scored, the best path is its vote, votes are counted per host
in Spark, and each page is extracted again from the host's winning path that fits it best.

Names that may also stand around the article (`with-sidebar`, `elementor-widget`) drop a part
only if the parts of that name do not hold the main unlinked text of the page.

Null and empty pages give the empty text; pages without a readable address share one host;
a page in which no winning path occurs falls back on its own best container; pages of any
length are read whole; repeated rows are extracted each; ties go to the smaller path.
`extract` carries all other columns, under the names the caller chooses.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import keep, whole

LEAST_SHARE = 0.05  # of a host's votes; so a host has 20 winning paths at most
HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/@]*@)?([^/:?#]+)"

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*|[^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z\-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
# Element kinds of HTML.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "html body address article aside blockquote caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr li main menu nav ol option p pre section select summary table "
    "tbody td tfoot th thead tr ul br".split())
CONTAINERS = frozenset("body article main section div td blockquote".split())
DROPPED = frozenset(
    "head nav header footer aside form button select option label fieldset input noscript template svg math canvas "
    "object audio video dialog menu script style textarea iframe".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
# Words in class names and ids of parts that are not the article.
DROPPED_NAMES = frozenset(
    "nav navbar navigation menu header footer sidebar aside ad ads adv advert adverts advertisement advertising sponsor "
    "sponsored banner cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe signup login "
    "search breadcrumb breadcrumbs share sharing social related recommended recommendations comment comments disqus "
    "respond replies reply promo promotion widget widgets pagination pager toolbar copyright".split())
KEPT_NAMES = frozenset("article content post entry main story text page body".split())
# Words that also name parts around an article, alone or only as a part of a longer name.
AMBIGUOUS_NAMES = frozenset("widget widgets notice notices related recommended recommendations".split())
AMBIGUOUS_PARTS = AMBIGUOUS_NAMES | frozenset("sidebar aside nav navbar navigation header footer".split())
WRAPS = frozenset("with has no without content layout".split())  # first parts of names that say what a part has
MAIN_SHARE = 0.5  # of a page's unlinked text, so that parts with an ambiguous name stay
NEVER_DROPPED = frozenset("html body main article".split())


def _names(attributes: dict[str, str]) -> list[str]:
    return (attributes.get("class", "") + " " + attributes.get("id", "")).lower().split()


def _is_dropped(tag: str, attributes: dict[str, str]) -> bool:
    if tag in DROPPED:
        return True
    if not attributes or tag in NEVER_DROPPED:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role") in DROPPED_ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")):
        return True
    parts = [re.split(r"[-_\d]+", name) for name in _names(attributes)]
    if any(part[0] in KEPT_NAMES and not DROPPED_NAMES.intersection(part) for part in parts):
        return False
    return any(_is_named(part) and not _is_ambiguous(part) for part in parts)


def _is_named(part: list[str]) -> bool:
    return part[0] in DROPPED_NAMES or part[-1] in DROPPED_NAMES


def _is_ambiguous(part: list[str]) -> bool:
    if len(part) == 1:
        return part[0] in AMBIGUOUS_NAMES
    words = DROPPED_NAMES.intersection((part[0], part[-1]))
    return part[0] in WRAPS or words <= AMBIGUOUS_PARTS


def _ambiguous_name(tag: str, attributes: dict[str, str]) -> str | None:
    """The name for which a part that is not dropped at once may still be dropped."""
    if not attributes or tag in NEVER_DROPPED:
        return None
    parts = [re.split(r"[-_\d]+", name) for name in _names(attributes)]
    if any(part[0] in KEPT_NAMES and not DROPPED_NAMES.intersection(part) for part in parts):
        return None
    return next(("-".join(part) for part in parts if _is_named(part)), None)


def _without_side_parts(blocks: list[tuple[str, str, int]], chains: list[tuple[str, ...]]) -> list[tuple[str, str, int]]:
    """Blocks that stand in no ambiguous part, or only in parts whose name holds the main unlinked text of the page."""
    if not any(chains):
        return blocks
    worth = [len(text) - linked for _, text, linked in blocks]
    held: dict[str, int] = {}
    for chain, n in zip(chains, worth):
        for name in set(chain):
            held[name] = held.get(name, 0) + n
    stays = {name for name, n in held.items() if n > 0 and n >= MAIN_SHARE * sum(worth)}
    return [block for block, chain in zip(blocks, chains) if stays.issuperset(chain)]


def _step(tag: str, attributes: dict[str, str]) -> str:
    classes = sorted({re.sub(r"\d+", "#", name) for name in attributes.get("class", "").lower().split()})
    return ".".join([tag, *classes])


def read_blocks(page: str | None) -> list[tuple[str, str, int]]:
    """Path, text and characters inside links of each block that is not dropped, in page order."""
    blocks: list[tuple[str, str, int]] = []
    chains: list[tuple[str, ...]] = []  # names of the ambiguous parts around each block
    stack: list[tuple[str, str, bool, tuple[str, ...]]] = []  # tag, path, dropped, chain
    parts: list[str] = []
    linked, in_link, path, dropped, chain = 0, 0, "", False, ()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append((path, text, min(linked, len(text))))
                chains.append(chain)
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not dropped:
            text = entities.unescape(raw)
            parts.append(text)
            linked += len(text) * bool(in_link)

    def leave(depth: int) -> None:
        nonlocal path, dropped, chain
        del stack[depth:]
        if chain != (stack[-1][3] if stack else ()):
            flush()
        _, path, dropped, chain = stack[-1] if stack else ("", "", False, ())

    page = page or ""
    at = 0
    while match := TAG.search(page, at):
        add(page[at:match.start()])
        at = match.end()
        closing, tag = match[1], (match[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            flush()
        if closing:
            if tag == "a":
                in_link = max(0, in_link - 1)
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if depth is not None:
                leave(depth)
            continue
        attributes = {}
        if match[3] and not match[3].isspace():
            attributes = {k.lower(): entities.unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(match[3])}
        closes = CLOSES.get(tag, CLOSES["p"] if tag in BLOCKS and tag != "br" else ())
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in closes:
                leave(depth)
                break
            if stack[depth][0] in SCOPES or stack[depth][0] in CONTAINERS:
                break
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID or match[3].endswith("/") and tag not in BLOCKS:
            continue
        if tag == "a":
            in_link += 1
        drops = dropped or _is_dropped(tag, attributes)
        name = None if drops else _ambiguous_name(tag, attributes)
        if name:
            flush()
            chain = (*chain, name)
        if tag in BLOCKS or drops or name:
            path = f"{path}>{_step(tag, attributes)}" if tag in BLOCKS and not drops else path
            dropped = drops
            stack.append((tag, path, dropped, chain))
    add(page[at:])
    flush()
    return _without_side_parts(blocks, chains)


def container_scores(blocks: list[tuple[str, str, int]]) -> dict[str, float]:
    """Score of each container path: its own blocks' unlinked text, and half of what its parts have."""
    scores: dict[str, float] = {}
    for path, text, linked in blocks:
        worth = max(0, len(text) - 2 * linked)
        steps = path.split(">")
        while len(steps) > 1:
            tag, *classes = steps[-1].split(".")
            if tag in CONTAINERS:
                bonus = 1.5 if tag in ("article", "main") else 0.5 if tag == "body" else 1.0
                if any(re.split(r"[-_#]+", name)[0] in KEPT_NAMES for name in classes):
                    bonus *= 1.25
                key = ">".join(steps)
                scores[key] = scores.get(key, 0.0) + worth * bonus
                worth *= 0.5
            steps.pop()
    return scores


def best_path(page: str | None) -> str | None:
    scores = container_scores(read_blocks(page))
    return min(scores, key=lambda path: (-scores[path], path)) if scores else None


def main_text(page: str | None, votes: dict[str, float]) -> str:
    """Text below the winning path with most votes times score; of the page's best path if none occurs."""
    blocks = read_blocks(page)
    scores = container_scores(blocks)
    if not scores:
        return " ".join(text for _, text, _ in blocks)
    won = [path for path in scores if path in votes and scores[path] > 0]
    chosen = min(won or scores, key=lambda path: (-scores[path] * votes.get(path, 1), path))
    return " ".join(text for path, text, _ in blocks if path == chosen or path.startswith(chosen + ">"))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(whole(url), HOST, 1))


def _vote(pages: pd.Series) -> pd.Series:
    return pd.Series([best_path(page) for page in pages], dtype=object)


def _extract(pages: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for html, winners in pages:
        yield pd.Series([
            main_text(page, {w["path"]: w["votes"] for w in won} if won is not None else {})
            for page, won in zip(html, winners)], dtype=object)


def winning_paths(pages: DataFrame, url: str = "url", html: str = "html", least_share: float = LEAST_SHARE) -> DataFrame:
    """(page_host, winners): the paths with at least that share of a host's votes."""
    votes = (pages.select(host(F.col(url)).alias("page_host"), F.pandas_udf(_vote, "string")(F.col(html)).alias("path"))
             .where(F.col("path").isNotNull()).groupBy("page_host", "path").agg(F.count("*").alias("votes")))
    votes = keep(votes, "path-votes")
    totals = votes.groupBy("page_host").agg(F.sum("votes").alias("all_votes"))
    return (votes.join(totals, "page_host").where(F.col("votes") >= least_share * F.col("all_votes"))
            .groupBy("page_host").agg(F.collect_list(F.struct("path", F.col("votes").cast("double").alias("votes"))).alias("winners")))


def extract(pages: DataFrame, url: str = "url", html: str = "html", text: str = "text") -> DataFrame:
    """Add the main text of each page."""
    inner = "__page_host"
    won = keep(winning_paths(pages, url, html), "winning-paths").withColumnsRenamed(
        {"page_host": inner, "winners": "__winners"})
    joined = pages.withColumn(inner, host(F.col(url))).join(won, inner, "left")
    return joined.withColumn(text, F.pandas_udf(_extract, "string")(F.col(html), F.col("__winners"))).drop(inner, "__winners")
