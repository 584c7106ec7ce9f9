"""Main text of HTML pages: structure, and differencing against the nearest page of the same host."""

from __future__ import annotations

import html
import pickle
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages
from .textkit import chunks, texts_of

# Element names and words of class and id attributes.
RAW = "script|style|noscript|template|svg|iframe|textarea|title|select|object|canvas"
DROPPED = frozenset("nav footer aside form button dialog menu head".split())
MAIN = frozenset("article main".split())
FRAMES = DROPPED | MAIN | frozenset("html body header div section ul ol table figure dl details fieldset".split())
BLOCKS = FRAMES | frozenset("p br hr h1 h2 h3 h4 h5 h6 li tr td th thead tbody caption blockquote pre figcaption dt dd address summary legend option center hgroup".split())
CUES = frozenset(
    "ad ads adv advert adverts advertisement banner cookie cookies consent gdpr notice alert promo promotion sponsor sponsored sidebar comment comments disqus reply replies respond menu nav navbar navigation breadcrumb breadcrumbs "
    "footer masthead popup modal overlay newsletter subscribe subscription share sharing social related recommended widget login signup toolbar pager pagination skip".split()
)
STRONG = frozenset("comment comments disqus cookie cookies footer".split())  # these win over the words of CONTENT
MODIFIERS = frozenset("has with no without is not".split())  # has-sidebar says what a page has, not what the block is
CONTENT = frozenset("article content main post entry body story text".split())

COPY = 0.8  # share of common lines above which a neighbour is a copy, not a template
NEAR = 4  # distinct outlines compared on each side, besides the page beyond a run of copies


def _tokens(raw: str) -> re.Pattern:
    """Comments, elements without text, tags; a tag whose quotes do not match ends at the next angle.

    No part gives back what it took and no two parts of a tag share a character,
    so with an angle ahead each token costs its own length.
    """
    return re.compile(
        rf"""<!--.*?(?P<ended>-->|\Z)|<(?P<raw>{raw})\b(?P<rawtext>[^>]*>.*?)(?P<closed></(?P=raw)\s*>|\Z)"""
        r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/<>]*+)(?P<rest>[^<>"']*+(?:(?:"[^"]*+"|'[^']*+')[^<>"']*+)*+)>|<(?P<odd_end>/?)(?P<odd>[a-zA-Z][^\s/<>]*+)[^>]*+>|<[!?/][^>]*+>""",
        re.DOTALL | re.IGNORECASE,
    )


_TOKEN, _WHOLE = _tokens(RAW), _tokens("script|style|title")


def tokens(page: str, whole: bool = False) -> Iterator[tuple[str, str, bool, str, str]]:
    """(text before, name of the tag or raw element, whether an end tag, attributes, raw text); the last has the text after all tags.

    Names are lower case and empty for comments and the like.  After the last
    angle nothing is a tag; an element or comment left open takes the rest.
    """
    at, stop = 0, page.rfind(">") + 1
    for m in (_WHOLE if whole else _TOKEN).finditer(page, 0, stop):
        before, at = page[at : m.start()], m.end()
        name = m["name"] or m["odd"] or m["raw"] or ""
        yield before, name.lower(), bool(m["end"] or m["odd_end"]), m["rest"] or "", m["rawtext"] or ""
        if m["closed"] == "" or m["ended"] == "":
            return
    yield page[at:].split("<!--", 1)[0], "", False, "", ""


_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NOT_LETTERS = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.IGNORECASE)


def attributes_of(attributes: str) -> dict[str, str]:
    """Values by lower-case name, without quotes; the first of repeated names counts."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(attributes):
        out.setdefault(name.lower(), value[1:-1] if value[:1] in ("'", '"') else value)
    return out


def _cued(attributes: str) -> int:
    """Whether class, id or role name boilerplate, or the block is hidden: 0 no, 1 unless it frames the page's text, 2 surely."""
    names: set[str] = set()
    hidden = False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            for token in value.split():
                words = [w for w in _NOT_LETTERS.split(_CAMEL.sub(r"\1 \2", token).lower()) if w]
                if not words or words[0] in MODIFIERS:
                    continue
                if STRONG.intersection(words) and all(w in CUES or w in CONTENT for w in words):
                    return 2
                names.update(words)
        hidden = hidden or name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (name == "style" and bool(_NO_DISPLAY.search(value)))
    return int(bool(names & CUES) and not names & CONTENT or hidden)


def lines_of(page: str | None, whole: bool = False) -> list[tuple[str, bool, bool]]:
    """The text lines of a page as (text, main, weak), boilerplate elements left out.

    A line is a block's text: references decoded, white space folded.  main: it
    stands in an article or main element.  weak: it stands outside one, or all
    its text is link text; only weak lines can be deleted as shared.
    """
    if not page:
        return []
    out: list[tuple[str, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []
    # cued frames: whether they hold an article, by number; the open ones; those around each line
    framing: list[bool] = []
    within: list[bool] = []  # whether they stand in an article themselves
    cued: list[int] = []
    around: list[tuple[int, ...]] = []
    dropped = depth = link = 0
    text: list[str] = []
    plain = False

    def close() -> None:
        nonlocal plain
        line = " ".join("".join(text).split())
        if line:
            out.append((line, depth > 0, depth == 0 or not plain))
            around.append(tuple(cued))
        text.clear()
        plain = False

    def add(piece: str) -> None:
        nonlocal plain
        if piece and not dropped:
            text.append(html.unescape(piece) if "&" in piece else piece)
            plain = plain or (not link and not piece.isspace())

    for before, name, ends, attributes, raw in tokens(page, whole):
        add(before)
        if raw or not name:
            continue
        if name == "a":
            link = 0 if ends else 1
        if name not in BLOCKS:
            continue
        close()
        if name not in FRAMES:
            continue
        if ends:
            if any(n == name for n, _, _ in stack):
                while stack:
                    n, d, c = stack.pop()
                    dropped -= d
                    if c:
                        cued.pop()
                    depth -= n in MAIN
                    if n == name:
                        break
        elif not attributes.rstrip().endswith("/"):
            cue = 0 if whole or name in ("html", "body") else _cued(attributes)
            drop = not whole and (name in DROPPED or name == "header" and not depth or cue == 2)
            if cue == 1 and not drop:
                cued.append(len(framing))
                framing.append(False)
                within.append(depth > 0)
            stack.append((name, drop, cue == 1 and not drop))
            if name in MAIN and not dropped and not drop:
                for c in cued:
                    framing[c] = True
            dropped += drop
            depth += name in MAIN
    close()
    if not framing:
        return out
    # a cued frame goes unless it holds an article, or most of the text where no article is marked around or beside it
    marked = any(m for _, m, _ in out)
    size = [0] * len(framing)
    for (t, _, _), frames in zip(out, around, strict=True):
        for c in frames:
            size[c] += len(t)
    whole = sum(len(t) for t, _, _ in out)
    gone = {c for c, holds in enumerate(framing) if not holds and (2 * size[c] <= whole or marked and not within[c])}
    return [x for x, frames in zip(out, around, strict=True) if not gone.intersection(frames)]


def main_lines(lines: list[tuple[str, bool, bool]], shared: np.ndarray | None) -> list[str]:
    """The lines that are not shared; where nothing could be compared, those in main elements if the page has any."""
    if shared is not None:
        return [t for k, (t, _, _) in enumerate(lines) if not shared[k]]
    inside = any(m for _, m, _ in lines)
    return [t for t, m, _ in lines if m or not inside]


def common_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which elements of a are in a longest common subsequence of a and b (bit-parallel rows, then traced back)."""
    out = np.zeros(len(a), bool)
    keep_a, keep_b = np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a))
    x, y = a[keep_a].tolist(), b[keep_b].tolist()
    places: dict[int, int] = {}
    for j, v in enumerate(y):
        places[v] = places.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1
    row, rows = full, [full]
    for v in x:
        m = places[v]
        u = row & m
        row = ((row + u) | (row - u)) & full
        rows.append(row)
    # a zero bit j of rows[i] says that the LCS of x[:i] and y[:j + 1] is one longer than that of y[:j]
    i, j = len(x), len(y)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            out[keep_a[i - 1]] = True
            i, j = i - 1, j - 1
    return out


def _address(url: str | None) -> tuple[str, str]:
    """Host and path of a URL; what does not parse is a path without host."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or ""), parts.path
    except ValueError:
        return "", url or ""


def _outline(frames):
    for part in chunks(frames, "html"):
        rows = []
        for key, url, page in zip(part["key"], texts_of(part["url"]), texts_of(part["html"]), strict=True):
            lines = lines_of(page)
            host, path = _address(url)
            rows.append((key, host, path, np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) >> 1 << 1 | m for t, m, _ in lines], np.uint64).tobytes()))
        yield pd.DataFrame(rows, columns=["key", "host", "path", "lines"])


def _path_in_common(a, b) -> int:
    n = 0
    for p, q in zip(a[2], b[2], strict=False):
        if p != q:
            break
        n += 1
    return n


@lru_cache(256)
def _shared(a: bytes, b: bytes) -> np.ndarray:
    """Which lines of outline a stand in outline b too; the last bit says that a line is in the article."""
    return common_lines(np.frombuffer(a, np.uint64) >> np.uint64(1), np.frombuffer(b, np.uint64) >> np.uint64(1))


def _alike(a, b) -> bool:
    """Whether two pages are nearly copies, or one nearly holds the other."""
    return a[3] == b[3] or int(_shared(a[3], b[3]).sum()) * 8 > COPY * min(len(a[3]), len(b[3]))


def _mask(row, before, after) -> bytes:
    """The shared lines of a page and the nearest page of its host that is not nearly a copy of it.

    before, after: (pages from the nearest on, the page beyond a run of copies).
    Nearer is the longer common path, then the place in URL order, the earlier if
    equal.  Whether pages are alike is judged by the article where one is marked;
    there a line goes only if every such page compared agrees, at two other paths or
    more, as articles may share a line by chance.  If all are alike without an article, it
    may be for a long template around a short text: then lines count as shared
    that pages at two other paths or more agree on.
    """
    main = np.frombuffer(row[3], np.uint64) & np.uint64(1) == 1
    found = []
    for side, (pages, far) in enumerate((before, after)):
        own = [p for p in pages if p[3] != row[3]][:NEAR]
        if far is not None and far[3] != row[3] and all(far[3] != p[3] for p in own):
            own.append(far)
        found += [(-_path_in_common(row, p), d, side, p) for d, p in enumerate(own)]
    agreed: dict[bytes, set] = {}
    every, different = None, set()
    for *_, page in sorted(found, key=lambda x: x[:3]):
        shared = _shared(row[3], page[3])
        if (shared[main] if main.any() else shared).mean() <= COPY:
            if not main.any():
                return shared.tobytes()
            every = shared if every is None else every & (shared | ~main)
            different.add(page[2])
        if page[2] != row[2] and not shared.all() and not main.any():
            agreed.setdefault(shared.tobytes(), set()).add(page[2])
    if every is not None:
        return (every if len(different - {row[2]}) > 1 else every & ~main).tobytes()
    return min((m for m, paths in agreed.items() if len(paths) > 1), key=lambda m: (m.count(1), m), default=b"")


def _seen(page, pages: list) -> list:
    """The pages of distinct outlines from this one on, one more than are compared, as one may equal the page itself."""
    return [page, *(p for p in pages if p[3] != page[3])][: NEAR + 1]


def _beyond(page, last, far):
    """The page beyond the run of copies that ends with last, seen from the page that follows it."""
    return far if last is None or _alike(page, last) else last


def _walk(rows: list, start: tuple) -> list[tuple]:
    """State (host, distinct pages, page beyond the run, last page) before each row and after all, in the order of rows."""
    host, pages, far, last = start
    out = []
    for row in rows:
        if row[1] != host:
            host, pages, far, last = row[1], [], None, None
        far = _beyond(row, last, far)
        out.append((host, pages, far, last))
        pages, last = _seen(row, pages), row
    return [*out, (host, pages, far, last)]


_NOTHING = (None, [], None, None)
_ROWS = "kind string, part int, at long, key long, host string, path string, lines binary"
_COLUMNS = [c.split()[0] for c in _ROWS.split(", ")]


def _number(frames):
    """The rows of a sorted partition with their places, and one row on its ends: what the partitions around it must know."""
    part = TaskContext.get().partitionId()
    rows: list = []
    for frame in frames:
        own = list(frame[["key", "host", "path", "lines"]].itertuples(index=False, name=None))
        yield pd.DataFrame([("row", part, len(rows) + k, *r) for k, r in enumerate(own)], columns=_COLUMNS)
        rows += own
    if rows:
        ends = []
        for order in (rows, rows[::-1]):
            # from the far end back to this one; only the host at this end matters
            host = [r for r in order if r[1] == order[0][1]]
            ends.append((len(host) == len(rows), order[0], _ends(host)))
        yield pd.DataFrame([("ends", part, 0, 0, None, None, pickle.dumps(ends))], columns=_COLUMNS)


def _ends(host: list) -> tuple[list, tuple | None]:
    """The first distinct pages of a host's rows and the first page beyond the run of copies they begin with."""
    pages: list = []
    for row in host:
        if len(pages) > NEAR:
            break
        if all(row[3] != p[3] for p in pages):
            pages.append(row)
    far = next((b for a, b in pairwise(host) if not _alike(a, b)), None)
    return pages, far


def _contexts(ends: list[tuple[int, list]], side: int) -> dict[int, tuple]:
    """The state in which each partition is entered, from before (side 0) or after (side 1)."""
    out, state = {}, _NOTHING
    for part, both in ends if side == 0 else ends[::-1]:
        (whole, first, _), (_, last, (pages, far)) = both[side], both[1 - side]
        out[part] = state
        if whole and state[0] == first[1]:
            far = far or _beyond(first, state[3], state[2])
            for p in reversed(pages):
                state = (None, _seen(p, state[1]), None, None)
            pages = state[1]
        state = (last[1], pages, far, last)
    return out


def _difference(before: dict[int, tuple], after: dict[int, tuple]):
    """Masks of the rows of whole partitions."""

    def masks(part: int, rows: list) -> pd.DataFrame:
        left = _walk(rows, before.get(part, _NOTHING))[:-1]
        right = _walk(rows[::-1], after.get(part, _NOTHING))[-2::-1]
        return pd.DataFrame({"key": [r[0] for r in rows], "mask": [_mask(r, a[1:3], b[1:3]) for r, a, b in zip(rows, left, right, strict=True)]})

    def run(frames):
        now, rows = None, []
        for frame in frames:
            for part, *row in frame[["part", "key", "host", "path", "lines"]].itertuples(index=False, name=None):
                if part != now and rows:
                    yield masks(now, rows)
                    rows = []
                now = part
                rows.append(tuple(row))
        if rows:
            yield masks(now, rows)

    return run


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of the article of every page.

    Elements that are never text of an article (menus, footers, scripts, forms,
    asides and blocks whose class or id says so) are left out while parsing.  The
    pages of a host are sorted by URL path, and each is paired with the nearest
    page of the host that is not nearly its copy; copies are passed over, however
    many.  Their lines are aligned by longest common subsequence, and shared
    lines are deleted, inside the article element and outside.  Where no page
    can be compared, the article element decides alone.

    Only hashes of lines are sorted, by ranges of host and path, so a host of any
    size spreads; of each range, some pages at both ends go to the driver, which
    tells the ranges around it.  Null or empty pages give an empty text, pages without
    neighbour are not differenced, equal rows agree.
    """
    spark, stages = pages.sparkSession, Stages(pages.sparkSession, "html")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").withColumn("key", F.xxhash64("page_id", "url", "html"))
    outline = base.select("key", "url", "html").mapInPandas(_outline, "key long, host string, path string, lines binary").filter("length(lines) > 0")
    found = stages.keep(outline.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "host", "path", "key").sortWithinPartitions("host", "path", "key").mapInPandas(_number, _ROWS), "outlines")
    ends = sorted((r["part"], pickle.loads(r["lines"])) for r in found.filter("kind = 'ends'").select("part", "lines").collect())
    around = spark.sparkContext.broadcast([_contexts(ends, side) for side in (0, 1)])
    dealt = found.filter("kind = 'row'").select("part", "at", "key", "host", "path", "lines").repartitionByRange(max(len(ends), 1), "part").sortWithinPartitions("part", "at")
    masks = dealt.mapInPandas(lambda frames: _difference(*around.value)(frames), "key long, mask binary")
    masks = masks.groupBy("key").agg(F.max("mask").alias("mask"))

    def extract(frames):
        for part in chunks(frames, "html"):
            text = []
            for page, mask in zip(texts_of(part["html"]), part["mask"], strict=True):
                lines = lines_of(page)
                shared = np.frombuffer(mask, bool) if isinstance(mask, bytes | bytearray) and len(mask) == len(lines) else None
                text.append(" ".join(main_lines(lines, shared)))
            yield pd.DataFrame({"page_id": part["page_id"], "url": part["url"], "text": text, "n_chars": [len(t) for t in text]})

    return base.join(masks, "key", "left").select("page_id", "url", "html", "mask").mapInPandas(extract, "page_id long, url string, text string, n_chars long")
