"""Main text of web pages with a suffix array per host.

A page is cut into blocks. The article or main element holds the text if there
is one; blocks of menus, forms, notices and the like go by their elements. Token
streams of whole pages are concatenated per host and their suffixes sorted: runs
that many distinct pages of the host share are its boilerplate, and their words
go from every page, inside articles too.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType

from tidemark.operators.joins import aggregate_for_join

# Words of a run, and the share and number of a host's pages that make it boilerplate.
RUN_WORDS = 6
PAGE_SHARE = 0.5
LEAST_PAGES = 3
# Distinct pages that hold a run inside articles too; fewer articles may have a sentence in common.
LEAST_ARTICLES = 5
# Share of an article's words in such runs from which on it is a near copy of others and stays as it is.
COPY_SHARE = 0.7
# Pages and bytes of one suffix array; hosts with more are split by a hash and their counts added up.
PAGES_SORTED = 1000
BYTES_SORTED = 64_000_000
# Distinct pages of a part of a host up to which it tells every run, not only those of several pages.
PAGES_TOLD = 64
# Boilerplate runs of all hosts up to which they are broadcast (16 bytes each); more are joined by host.
BROADCAST_RUNS = 1_000_000

# Element names that never hold article text, with everything inside them.
_NO_TEXT = frozenset("script style noscript template textarea iframe svg math object select button head title canvas audio video".split())
_BESIDE = frozenset("nav footer aside form dialog menu".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SPACED = frozenset("br td th img".split())
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice notices notification alert popup modal overlay newsletter subscribe signup menu nav navbar navigation"
    " breadcrumb breadcrumbs sidebar widget widgets related recommended recommendations share sharing social footer header"
    " masthead comment comments reply replies discussion disqus respond form login search pagination pager toolbar"
    " contentinfo complementary dialog alertdialog menubar".split()
)
_NOT_HINT = frozenset("has with no without content article main post entry body text story page".split())
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"""  # a stray quote
    r"""|<[!?][^>]*>""",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_TOPIC = re.compile(r"\b(?:category|tag)-[\w-]+")  # of an article, not its part in the page
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)


def host(url: Column) -> Column:
    """Host of an address in lower case; empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def _beside(attributes: str) -> bool:
    """Whether class, id or role name something beside the article."""
    if _HIDDEN.search(attributes):
        return True
    for _, *values in _NAMES.findall(attributes):
        for name in "".join(values).lower().split():
            parts = re.split(r"[^a-z]+", name)
            if any(p in _HINTS for p in parts) and not any(p in _NOT_HINT for p in parts):
                return True
    return False


def blocks(page: str) -> list[tuple[str, int, bool]]:
    """Text blocks in page order: text, place (2 inside article or main, 1 elsewhere, 0 beside it), and mostly links.

    An article that its own attributes or a hint around it call something else is
    doubtful. The page's largest one counts, if it is longer than the text outside
    and neither nested in another article nor after one; other doubtful ones are
    beside the text. Several articles shorter than the text outside are teasers.
    White space inside a block is one space. An element that is never closed
    ends with the element around it; markup that ends inside a tag is text no more.
    """
    out: list[tuple[str, int, bool]] = []
    text: list[str] = []
    linked = 0
    opened: list[tuple[str, int]] = []  # open elements that matter, and what they open: 1 beside, 2 main, 3 link
    state = [0, 0, 0, 0]  # elements open of each kind
    articles: list[tuple[str, bool, bool]] = [("", False, False)]  # element, whether doubtful, whether another is around or before it
    inside: list[int] = []  # article of each block, 0 for none
    own = 0  # article that is open
    held: dict[int, tuple[int, int]] = {}  # by place in opened: hints around an article, without effect in it, and the article around it
    at = 0

    def end_block() -> None:
        nonlocal linked
        if text:
            joined = "".join(text)
            text.clear()
            if "&" in joined:
                joined = entities.unescape(joined)
            words = joined.split()
            if words:
                joined = " ".join(words)
                place = 0 if state[1] else 2 if state[2] else 1
                out.append((joined, place, linked * 2 > len(joined)))
                inside.append(own if place == 2 else 0)
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            text.append(piece)
            if state[3]:
                linked += len(piece)

    position, size = 0, len(page)
    while position < size:
        found = _TAG.search(page, position)
        if not found:
            rest = page[at:]
            cut = re.search(r"<[a-zA-Z/!?][^>]*\Z", rest)
            add(rest[: cut.start()] if cut else rest)
            break
        add(page[at : found.start()])
        at = position = found.end()
        closing, name, attributes = found.groups()[:3] if found[2] else found.groups()[3:]
        name = (name or "").lower()
        if not name:
            continue
        if not closing and name in _NO_TEXT and not attributes.endswith("/"):
            if name in _BLOCKS or name == "head":
                end_block()
            stop = re.compile(rf"</{re.escape(name)}\s*>" + (r"|<body\b" if name == "head" else ""), re.I).search(page, at)
            if name == "head" and stop and stop[0][1:2] != "/":
                at = position = stop.start()
            else:
                at = position = stop.end() if stop else size
            continue
        if name in _SPACED:
            text.append(" ")
            continue
        block = name in _BLOCKS
        if block:
            end_block()
        if name in _VOID:
            continue
        if closing:
            for i in range(len(opened) - 1, -1, -1):
                if opened[i][0] == name:
                    for k in range(len(opened) - 1, i - 1, -1):
                        state[opened[k][1]] -= 1
                        if k in held:
                            hints, own = held.pop(k)
                            state[1] += hints
                    del opened[i:]
                    break
            continue
        kind = 0
        if name in ("article", "main"):
            kind = 2
            if not (state[1] and any(k == 1 and n in _BESIDE for n, k in opened)):
                doubt = state[1] > 0 or name == "article" and _beside(_TOPIC.sub("", attributes))
                if doubt or not own:
                    held[len(opened)] = state[1], own
                    state[1] = 0
                    articles.append((name, doubt, own > 0 or any(n == "main" or not doubtful for n, doubtful, _ in articles[1:])))
                    own = len(articles) - 1
        elif name == "a":
            kind = 3
        elif name in _BESIDE or name == "header" and not state[2] or attributes and name not in ("html", "body") and _beside(attributes):
            kind = 1
        if name in ("p", "li", "dt", "dd", "option", "tr") and opened and opened[-1][0] == name:
            state[opened.pop()[1]] -= 1  # its end tag is optional
        if kind or block and name not in ("html", "body") or opened and opened[-1][1] == 1:
            opened.append((name, kind))
            state[kind] += 1
    end_block()
    return _placed(out, inside, articles)


def _placed(found: list[tuple[str, int, bool]], inside: list[int], articles: list[tuple[str, bool, bool]]) -> list[tuple[str, int, bool]]:
    """The blocks, those of doubtful articles and of teasers beside the text."""
    sizes = [0] * len(articles)
    for (block, place, links), k in zip(found, inside, strict=True):
        if k or place == 1 and not links:
            sizes[k] += len(block)
    sure = [k for k in range(1, len(articles)) if not articles[k][1]]
    gone = {k for k in range(1, len(articles)) if articles[k][1]}
    if gone:
        first = [k for k in gone if not articles[k][2]]
        largest = max(first + sure, key=sizes.__getitem__, default=0)
        if sizes[largest] > sizes[0]:
            gone.discard(largest)
    if len(sure) > 1 and all(articles[k][0] == "article" for k in sure) and sum(sizes[k] for k in sure) < sizes[0]:
        gone.update(sure)
    if not gone:
        return found
    return [(block, 0 if k in gone else place, links) for (block, place, links), k in zip(found, inside, strict=True)]


def _runs(words: list[str]) -> list[int]:
    """A number for each run of words, or for all words if they are fewer."""
    n = min(RUN_WORDS, len(words))
    return [_number(words[i : i + n]) for i in range(len(words) - n + 1)]


def _number(words: list[str]) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "replace")) - (1 << 63)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page with text: host and its text, a block per line after its place."""
    for batch in batches:
        hosts, texts = [], []
        for name, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = blocks(page or "")
            if found:
                hosts.append(name)
                texts.append("\n".join(f"{place}{block}" for block, place, _ in found))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(texts, pa.string())], ["host", "stream"])


def suffix_order(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` tokens by doubling, and the common prefix of each with the one before.

    Common prefixes are 0 or ``depth``: shorter ones are of no use here.
    """
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    length = 1
    while length < depth:
        step = min(length, depth - length)
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = rank[step:]
        rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)[1].astype(np.int64) + 1
        length += step
    order = np.argsort(rank, kind="stable")
    common = np.zeros(n, np.int64)
    common[1:] = np.where(rank[order[1:]] == rank[order[:-1]], depth, 0)
    return order, common


def _repeated(table: pa.Table) -> pa.Table:
    """Runs that several distinct pages of a group share: host, run, pages, pages that hold it outside articles.

    The row without a run has the distinct pages of the group. A small part of a
    host tells the runs of single pages too, as its other parts may hold them.
    """
    name, found = table.column("host")[0].as_py(), []
    words, pages, outside, ids = [], [], [], {}
    streams = table.column("stream").unique().to_pylist()
    for page, stream in enumerate(streams):
        for line in stream.split("\n"):
            own = line[1:].split()
            # A block shorter than a run is filled up, so that it matches as a whole; a break no other block has follows.
            filled = own + [""] * (RUN_WORDS - len(own))
            words.extend([*filled, None])
            pages.append((page, len(filled) + 1))
            outside.append(line[0] != "2")
    tokens = np.array([-1 if word is None else ids.setdefault(word, len(ids)) for word in words], np.int64)
    breaks = np.flatnonzero(tokens < 0)
    tokens[breaks] = -1 - breaks
    order, common = suffix_order(tokens, RUN_WORDS)
    number, length = np.array(pages, np.int64).T
    owner, out = np.repeat(number, length)[order], np.repeat(np.array(outside), length)[order]
    # Suffixes of one run are in page order: a page counts at its first one.
    opens = common < RUN_WORDS
    group = np.cumsum(opens) - 1
    new = opens | (owner != np.append(-1, owner[:-1]))
    support = np.bincount(group[new])
    apart, at = owner[out], group[out]
    first = np.append(True, (apart[1:] != apart[:-1]) | (at[1:] != at[:-1]))[: len(at)]
    beside = np.bincount(at[first], minlength=len(support))
    start = order[np.flatnonzero(opens)]
    told = 0 if table.column("parts")[0].as_py() > 1 and len(streams) <= PAGES_TOLD else 1
    # A run goes over no break: the suffixes that start at one or reach one are of one page only.
    for k in np.flatnonzero((support > told) & (tokens[start] >= 0)).tolist():
        if None in (run := words[start[k] : start[k] + RUN_WORDS]):
            continue
        run = [w for w in run if w]
        found.append((_number(run), int(support[k]), int(beside[k])))
    found.append((None, len(streams), 0))
    runs, many, beside = zip(*found, strict=True)
    return pa.table({"host": pa.array([name] * len(found), pa.string()), "run": pa.array(runs, pa.int64()), "pages": pa.array(many, pa.int64()), "outside": pa.array(beside, pa.int64())})


def host_boilerplate(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """Runs of words that at least half of a host's distinct pages hold: ``host``, ``run``.

    LEAST_PAGES hold it outside their articles, or LEAST_ARTICLES anywhere. Pages of
    equal blocks are one. In a host of several parts, a run may miss one page for
    each part of more than PAGES_TOLD distinct pages. A host's runs are fewer than twice the words of its mean page.
    """
    from tidemark.llm.common import written

    known = pages.select(host(F.col(url)).alias("host"), F.col(html))
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / PAGES_SORTED, F.sum(F.octet_length(html)) / BYTES_SORTED))
    # Written, so that Spark knows how small it is: a row for each host of several parts.
    split = written(aggregate_for_join(known, ["host"], parts.alias("parts")).where("parts > 1"), "host-parts")
    streams = known.mapInArrow(_streams, "host string, stream string")
    # Equal pages of a host meet in one part.
    parts = F.coalesce("parts", F.lit(1))
    dealt = streams.join(split, "host", "left").select("host", F.pmod(F.xxhash64("stream"), parts).alias("part"), "stream", parts.alias("parts"))
    found = written(dealt.groupBy("host", "part").applyInArrow(_repeated, "host string, run long, pages long, outside long"), "runs")
    sizes = found.where("run IS NULL").groupBy("host").agg(F.sum("pages").alias("host_pages"))
    half = PAGE_SHARE * F.col("host_pages")
    inside = (F.col("pages") >= LEAST_ARTICLES) & (F.col("pages") >= half)
    return (
        found.where("run IS NOT NULL")
        .groupBy("host", "run")
        .agg(F.sum("pages").alias("pages"), F.sum("outside").alias("outside"))
        .where(F.col("pages") >= LEAST_PAGES)
        .join(sizes, "host")
        .where(inside | (F.col("outside") >= LEAST_PAGES) & (F.col("outside") >= half))
        .select("host", "run")
    )


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: key, address, ``text`` and ``blocks``, the array of its lines.

    A null or empty html gives an empty text. Pages without a host are one host.
    In a page without article or main element, all blocks count that are not
    beside it, mostly links or host boilerplate. Inside an article only runs of
    RUN_WORDS words or more can be boilerplate; an article that is COPY_SHARE of
    such runs is a near copy of other pages and stays as it is. Repeated rows are
    repeated and change no text; null keys are kept. Other columns are not read,
    whatever their names. Pages are taken whole, whatever their length.
    """
    from tidemark.llm.common import written

    runs = written(host_boilerplate(pages, url=url, html=html).groupBy("host").agg(F.collect_list("run").alias("runs")), "boilerplate")
    size = runs.agg(F.sum(F.size("runs") + 4)).first()[0] or 0
    own = pages.select(page_id, url, F.col(html).alias("_html"), host(F.col(url)).alias("host"))
    joined = own.join(F.broadcast(runs) if size <= BROADCAST_RUNS else runs, "host", "left").select(page_id, url, "runs", "_html")
    schema = pages.select(page_id, url).schema.add("text", "string").add("blocks", ArrayType(StringType()))
    return joined.mapInArrow(_extracted(page_id, url), schema)


def _extracted(page_id: str, url: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[int, frozenset] = {}
            kept = []
            lists = batch.column(2)
            for i, page in enumerate(batch.column(3).to_pylist()):
                runs = lists[i]
                key = hash(runs.values.to_numpy().tobytes()) if runs.is_valid else 0
                if key not in known:
                    known[key] = frozenset(runs.as_py() or ())
                kept.append(_kept(blocks(page or ""), known[key]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(["\n".join(k) for k in kept], pa.string()), pa.array(kept, pa.list_(pa.string()))],
                [page_id, url, "text", "blocks"],
            )

    return run


def _kept(found: list[tuple[str, int, bool]], boilerplate: frozenset) -> list[str]:
    place = 2 if any(p == 2 for _, p, _ in found) else 1
    own = [b for b, p, links in found if p == place and not (place == 1 and links)]
    if not boilerplate:
        return own
    out = [left for b in own if (left := _left(b, boilerplate, place))]
    if place == 2:
        n, kept = (sum(b.count(" ") + 1 for b in texts) for texts in (own, out))
        if kept <= (1 - COPY_SHARE) * n:
            return own
    return out


def _left(block: str, boilerplate: frozenset, place: int) -> str:
    """The block without the words of its boilerplate runs."""
    words = block.split()
    if place == 2 and len(words) < RUN_WORDS:
        return block
    hits = [i for i, run in enumerate(_runs(words)) if run in boilerplate]
    if not hits:
        return block
    gone = {k for i in hits for k in range(i, i + RUN_WORDS)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)
