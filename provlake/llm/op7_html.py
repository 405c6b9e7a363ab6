"""HTML extraction: page structure, and a suffix array over each host's token streams.

Every page is cut into blocks.  The token streams of all pages of a host, whatever elements they are in,
are concatenated, a suffix array finds runs of RUN or more tokens that stand on PAGES or more different
pages, and tokens covered by such runs are boilerplate.  Structure is the extra check.  Blocks in an
article or main element that are not in a menu, header, footer, sidebar, notice, advert, form or comment
are the article: those that such runs cover whole are dropped, but its h1 stays, and it stays whole if
more than half of it is covered, as copied articles are still articles.  A page without such an element
keeps the unique runs of its remaining blocks.

Hosts are dealt in parts of about PART bytes of html by a hash of the page, so a host of any size makes
tasks of bounded size; a page's blocks travel deflated.  The evidence is the whole host's: each part of a host of several sends the keys of its
distinct runs with their numbers of pages, the numbers are added up over the parts in slices of the keys,
and each part gets back those of its keys that stand on PAGES pages of the host.  A key has KEY_BITS
bits, so two different runs of a host of 10 million runs share one with a chance of 4e-8 for each run.

Defined cases: null or empty html gives an empty text; pages that repeat come back as
often as they came; a null url is a host of its own; cut-off markup at the end of a page is dropped and
cut-off character references are text; an empty table gives no rows.
"""

from __future__ import annotations

import html as _html
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.llm.common import cut, mix, small, table
from provlake.llm.fm_index import suffix_order

RUN, PAGES, PART = 6, 3, 6 << 20
#: Bits of a run's key (whole bytes); parts whose keys one slice holds.
KEY_BITS, SLICE = 48, 8

_TOKEN = re.compile(
    r"[^<]++|<!--.*?(?:-->|$)|<(script|style|noscript|template|textarea|svg|iframe|title)\b.*?(?:</\1\s*>|$)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|$)|"
    r"<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|$)|<(/?)([a-zA-Z][\w:-]*)([^>]*+)(?:>|$)|<",
    re.S | re.I,
)
_MARK = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
#: Words of class, id and role names that mark boilerplate.
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|nav\w*|menu\w*|breadcrumbs?|sidebar|side|aside|widget|"
    r"footer|header|masthead|topbar|toolbar|pagination|pager|comments?|disqus|replies|respond|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|"
    r"popup|modal|overlay|dialog|search|form|contentinfo|complementary|navigation|skip\w*|copyright|legal|disclaimer)(?:$|[\s_-])",
    re.I,
)
#: The same inside an article: what marks boilerplate as a part of a name, and what only as a whole one.
_INSIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor(?:s|ed)?|promo|cookies?|gdpr|nav|navbar|navigation|menu|breadcrumbs?|sidebar|widget|footer|pagination|pager|"
    r"comments?|disqus|share|sharing|newsletter|subscribe|signup|popup|modal)(?:$|[\s_-])|"
    r"(?:^|\s)(?:banner|consent|notices?|alert|side|aside|masthead|topbar|toolbar|replies|respond|social|related|recommend\w*|login|"
    r"overlay|dialog|search|form|contentinfo|complementary|skip\w*|copyright|legal|disclaimer)(?:$|\s)",
    re.I,
)
_BOILER = frozenset("nav footer aside form menu dialog button select option label fieldset head".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = _BLOCK - {"body", "html", "head"}


def blocks(page: str | None) -> list[tuple[str, bool, bool, bool]]:
    """(text, in an article or main element, in boilerplate by structure, in an h1) of each block that has text."""
    out: list[tuple[str, bool, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []
    held: list[str] = []
    main = boiler = False

    def flush() -> None:
        if held:
            raw = "".join(held)
            text = " ".join((_html.unescape(raw) if "&" in raw else raw).split())
            held.clear()
            if text:
                out.append((text, main, boiler, any(x[0] == "h1" for x in stack)))

    for m in _TOKEN.finditer(page or ""):
        got = m[0]
        if got[0] != "<":
            held.append(got)
            continue
        if (tag := m[3] or m[6]) is None:
            if got == "<":
                held.append(got)
            elif got.startswith("<![CDATA["):
                held.append(_html.escape(got[9:-3]))
            continue
        tag = tag.lower()
        if got[-1] != ">":
            continue  # a tag cut off by the page's end
        if tag in _BLOCK:
            flush()
        elif tag == "br":
            held.append(" ")
        if tag in _VOID:
            continue
        if got[1] == "/":
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    # an inline end tag doesn't close the blocks around it
                    if tag in _BLOCK or not any(s[0] in _BLOCK for s in stack[i + 1 :]):
                        del stack[i:]
                    break
        else:
            if tag in _CLOSES_P and stack:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p" or tag == "li" and stack[i][0] == "li":
                        del stack[i:]
                        break
                    if stack[i][0] in _BLOCK:
                        break
            attrs = m[4] or m[7]
            named = [(k.lower(), x.strip("\"'")) for k, x in _MARK.findall(attrs)] if attrs else []
            marks = " ".join(x for _, x in named)
            is_main = tag in ("article", "main") or "main" in marks.split() and tag in ("div", "section")
            if main or is_main:  # a label there may be any heading
                names, marks = _INSIDE.search, " ".join(x for k, x in named if k != "aria-label")
            else:
                names = _NAMES.search
            bad = tag in _BOILER or (tag == "header" and not main) or bool(marks and tag not in ("body", "html") and names(marks)) or bool(attrs and _HIDDEN.search(attrs))
            stack.append((tag, main or is_main, boiler or bad))
        main, boiler = stack[-1][1:] if stack else (False, False)
    flush()
    return out


def article(found: list[tuple[str, bool, bool, bool]]) -> list[int] | None:
    """Places of the article's blocks; None if no article or main element has text outside boilerplate."""
    return [i for i, (_, main, bad, _) in enumerate(found) if main and not bad] or None


def host_runs(streams: list[list[list[str]]], owners: list, run: int = RUN) -> tuple:
    """The suffix array's runs of ``run`` tokens over the streams of a host's pages.

    seq (token numbers, 0 ends a block), places of the runs, the group of equal runs each is in, how many
    pages each group stands on, the distinct tokens, and the pages of each whole block.  A page may
    come in several rows: ``owners`` names each stream's page.
    """
    number: dict[str, int] = {}
    page: dict = {}
    flat, owner, whole = [], [], defaultdict(set)
    for name, stream in zip(owners, streams):
        p = page.setdefault(name, len(page))
        for block in stream:
            if len(block) < run:
                whole[tuple(block)].add(p)
            flat += [*[number.setdefault(t, len(number) + 1) for t in block], 0]  # runs end with their block
            owner += [*[p] * len(block), -1]
    seq, own = np.array(flat, np.int64), np.array(owner, np.int64)
    order = group = on = np.zeros(0, np.int64)
    if len(seq) > run:
        order = suffix_order(seq, 8 * (run // 8 + 1))
        order = order[order <= len(seq) - run]
        inside = np.ones(len(order), bool)
        for j in range(run):
            inside &= seq[order + j] > 0
        order = order[inside]
    if len(order):
        same = np.ones(len(order) - 1, bool)
        for j in range(run):
            same &= seq[order[:-1] + j] == seq[order[1:] + j]
        group = np.concatenate(([0], np.cumsum(~same)))
        pairs = np.unique(group * np.int64(len(page)) + own[order]) // len(page)
        on = np.bincount(pairs, minlength=group[-1] + 1)
    return seq, order, group, on, number, whole


def run_keys(seq: np.ndarray, at: np.ndarray, number: dict[str, int], run: int) -> np.ndarray:
    """KEY_BITS-bit keys of the runs at these places, the same in every part of a host."""
    token = np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "replace")) for t in number], np.uint64)
    h = np.zeros(len(at), np.uint64)
    for j in range(run):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + token[seq[at + j] - 1])
    return h >> np.uint64(64 - KEY_BITS)


def block_key(block: tuple[str, ...]) -> int:
    return xxhash.xxh64_intdigest(" ".join(block).encode("utf-8", "replace"), len(block)) >> (64 - KEY_BITS)


def evidence(streams: list[list[list[str]]], owners: list, run: int = RUN, pages: int = PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of a part's distinct runs and whole short blocks, and on how many pages (at most ``pages``) each stands."""
    seq, order, group, on, number, whole = host_runs(streams, owners, run)
    first = np.flatnonzero(np.diff(group, prepend=-1))
    keys = np.concatenate((run_keys(seq, order[first], number, run), np.array([block_key(b) for b in whole], np.uint64)))
    n = np.concatenate((on, np.array([len(p) for p in whole.values()], np.int64)))
    return add_up(keys, n, pages)


def add_up(keys: np.ndarray, n: np.ndarray, pages: int) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.minimum(np.bincount(place, n, len(distinct)), pages).astype(np.uint8)


def pack(keys: np.ndarray, n: np.ndarray) -> bytes:
    """Byte planes of the sorted keys' differences, and the counts; a shuffle's codec shortens the upper planes."""
    step = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return step[:, : KEY_BITS // 8].T.tobytes() + n.astype(np.uint8).tobytes()


def unpack(got: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(got, np.uint8).reshape(KEY_BITS // 8 + 1, -1)
    step = np.zeros((planes.shape[1], 8), np.uint8)
    step[:, : KEY_BITS // 8] = planes[:-1].T
    return np.cumsum(step.view("<u8").ravel(), dtype=np.uint64), planes[-1]


def kept_blocks(streams: list[list[list[str]]], owners: list, run: int = RUN, pages: int = PAGES, known: np.ndarray | None = None) -> list[list[tuple[list[str], bool]]]:
    """For each block its tokens that no run shared by ``pages`` pages covers, and whether all are covered.

    ``known``: sorted keys of runs and blocks that stand on so many pages of the whole host.
    """
    seq, order, group, on, number, whole = host_runs(streams, owners, run)
    covered = np.zeros(len(seq), bool)
    often = on >= pages
    common: set = set()
    if known is not None and len(known):
        common = {b for b in whole if _holds(known, np.array([block_key(b)], np.uint64))[0]}
        if len(order):
            often = often | _holds(known, run_keys(seq, order[np.flatnonzero(np.diff(group, prepend=-1))], number, run))
    if len(order):
        at = order[often[group]]
        for j in range(run):
            covered[at + j] = True
    out, i = [], 0
    for stream in streams:
        kept = []
        for block in stream:
            c = covered[i : i + len(block)]
            i += len(block) + 1
            if len(block) < run:
                left = block if len(whole[tuple(block)]) < pages and tuple(block) not in common else []
            else:
                left = [t for t, x in zip(block, c) if not x]
                if c.any() and len(left) < run:
                    left = []  # what is left of a block is too short to be a unique run
            kept.append((left, bool(c.all())))
        out.append(kept)
    return out


def _holds(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


#: What a block is by structure.
SPARE, LOOSE, ARTICLE, TITLE = range(4)


def page_text(stream: list[list[str]], kinds: list[int], kept: list[tuple[list[str], bool]]) -> str:
    """A page's text: what the runs leave of it, with whole blocks, titles and copied articles protected."""
    art = [i for i, k in enumerate(kinds) if k >= ARTICLE]
    if not art:
        return "\n".join(" ".join(kept[i][0]) for i, k in enumerate(kinds) if k == LOOSE and kept[i][0])
    gone = {i for i in art if kinds[i] == ARTICLE and kept[i][1]}
    if 2 * sum(len(stream[i]) for i in gone) > sum(len(stream[i]) for i in art):
        gone = set()  # a copied article is an article
    return "\n".join(" ".join(stream[i]) for i in art if i not in gone)


_DEALT = "page_id long, url string, body binary, kinds binary"
_KEYS_DDL = "host string, part long, slice int, keys binary"
_KEYS = pa.schema([("host", pa.string()), ("part", pa.int64()), ("slice", pa.int32()), ("keys", pa.binary())])
_TEXT = "page_id long, url string, text string"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        texts, kinds = [], []
        for page in b.column(2).to_pylist():
            found = blocks(page)
            art = article(found)
            inside = set(art or ())
            texts.append(zlib.compress("\n".join([t for t, *_ in found]).encode("utf-8", "replace"), 6))
            kinds.append(bytes([(TITLE if h1 else ARTICLE) if i in inside else LOOSE if art is None and not bad else SPARE for i, (_, _, bad, h1) in enumerate(found)]))
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1), pa.array(texts, pa.binary()), pa.array(kinds, pa.binary())], names=["page_id", "url", "body", "kinds"])


def _streams(rows: pa.Table) -> tuple[list, list, list]:
    ids, urls = rows["page_id"].to_pylist(), rows["url"].to_pylist()
    pages = [zlib.decompress(x).decode("utf-8") for x in rows["body"].to_pylist()]
    return ids, urls, [[t.split(" ") for t in page.split("\n")] if page else [] for page in pages]


def _evidence(rows: pa.Table) -> pa.Table:
    """The keys of one part of a host that has several, in slices by their highest bits."""
    out, parts = [], rows["parts"][0].as_py()
    if parts > 1:
        ids, urls, streams = _streams(rows)
        keys, n = evidence(streams, list(zip(ids, urls)))
        slices = -(-parts // SLICE)
        edge = np.searchsorted(keys * np.uint64(slices) >> np.uint64(KEY_BITS), np.arange(slices + 1, dtype=np.uint64))
        out = [(rows["host"][0].as_py(), rows["part"][0].as_py(), i, pack(keys[a:b], n[a:b])) for i, (a, b) in enumerate(zip(edge.tolist(), edge[1:].tolist())) if b > a]
    return pa.Table.from_pylist([dict(zip(_KEYS.names, x)) for x in out], _KEYS)


def _common(rows: pa.Table) -> pa.Table:
    """Of one slice of a host's keys, each part's share of those that stand on PAGES pages of the host."""
    had = [unpack(x) for x in rows["keys"].to_pylist()]
    keys, n = add_up(np.concatenate([k for k, _ in had]), np.concatenate([c for _, c in had]), PAGES)
    often = keys[n >= PAGES]
    out = []
    for host, part, i, (k, c) in zip(rows["host"].to_pylist(), rows["part"].to_pylist(), rows["slice"].to_pylist(), had):
        mine = k[np.isin(k, often) & (c < PAGES)]  # others are seen in the part itself
        if len(mine):
            out.append((host, part, i, pack(mine, np.full(len(mine), PAGES))))
    return pa.Table.from_pylist([dict(zip(_KEYS.names, x)) for x in out], _KEYS)


def _host_part(rows: pa.Table, known: pa.Table) -> pa.Table:
    ids, urls, streams = _streams(rows)
    keys = [unpack(x)[0] for x in known["keys"].to_pylist()]
    kept = kept_blocks(streams, list(zip(ids, urls)), known=np.sort(np.concatenate(keys)) if keys else None)
    texts = [page_text(s, k, x) for s, k, x in zip(streams, rows["kinds"].to_pylist(), kept)]
    return pa.table([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, part: int = PART) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    host = F.coalesce(F.regexp_extract("url", r"://([^/?#]*)", 1), F.lit(""))
    sizes = cut(base.groupBy(host.alias("host")).agg(F.sum(F.octet_length("html")).alias("n")).select("host", F.greatest(F.ceil(F.coalesce("n", F.lit(0)) / part), F.lit(1)).alias("parts")), "op7-hosts")
    streams = base.mapInArrow(_parse, _DEALT).withColumn("host", host)
    dealt = streams.join(sizes, "host").withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.col("parts")))
    # both uses of the dealt pages read one shuffle
    keys = dealt.groupBy("host", "part").applyInArrow(_evidence, _KEYS_DDL)
    known = keys.groupBy("host", "slice").applyInArrow(_common, _KEYS_DDL)
    got = dealt.groupBy("host", "part").cogroup(known.groupBy("host", "part")).applyInArrow(_host_part, _TEXT)
    return got.withColumn("n_chars", F.char_length("text").cast("long"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
