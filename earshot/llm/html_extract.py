"""Main text of web pages: token streams with roles and a suffix array of each host.

A small reader walks a page's tags and cuts it into blocks. Markup is evidence with
a weight. Text in navigation, footers, asides, forms, hidden parts and elements whose
class names chrome and nothing else (``site-footer``, ``ad-slot``) is chrome. An
element named chrome with a word of its own before (``lunch-menu``) is chrome unless
it holds more text than all the rest. ``article`` and ``main``, and with less weight classes
such as ``post-content``, are candidates for the main part.

All tokens of all pages, main parts and chrome included, go into the suffix array of their host:
suffixes are brought together by their first ``RUN`` tokens (a longer run is the chain of its
suffixes), and markup weighs what the array finds. A run is boilerplate if it stands on two distinct
pages outside main parts that markup settles. Text that is at home in the main part of one page, elsewhere
on ``VERSIONS`` pages at most and nowhere in named chrome is none: so the print version of an article keeps it. A candidate is
the main part if it holds at least as many unique tokens as the plain text around it, and is
kept whole; a weakly named element stays if its unique tokens outweigh the rest; else the page keeps
the unique runs of all its plain blocks.

The array alone could not meet the contract: footers that differ from page to page would stay, and
articles or paragraphs that a host shows twice would go. So a main part with no plain text around it
is kept whole whatever the array finds in it, and no run reaches across its border.

Tasks bundle the hashes of their pages' runs, sorted, by ranges of hashes; a range's owner meets all
bundles of the range. A host with a third of all pages is spread over all ranges, and no task holds
a host. What the array finds is joined with the runs of pages that markup doesn't settle.
"""

from __future__ import annotations

import hashlib
import html as entities
import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import map_rows, materialize, rows_per_batch, table

RUN = 8
#: Runs are compared by so many bits of their hash.
BITS = 60
#: A task bundles so many runs (and one batch at least) before it deals them out; a range of hashes has about so many.
BUNDLE_RUNS, RANGE_RUNS = 2_000_000, 1_000_000
#: There are so many ranges at least.
RANGES = 16
#: Other versions of an article that a host may show outside of a main part.
VERSIONS = 3
#: Pages that are cut into tokens at once.
BATCH_PAGES = 1_000
#: Pages whose text stands in several rows are listed up to so many (8 bytes each); beyond it, every page is taken for one of them.
COPIES = 500_000
_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|noscript|template|svg|iframe|select|title|math|canvas|object|audio|video|button)\b"
    r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s>/=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)))?")
_NAME = re.compile(r"[a-z]+")
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINERS = frozenset("article aside blockquote body details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split())
_CHROME_TAGS = frozenset("nav footer aside menu dialog head".split())
#: Why a block is chrome: by tag, role or name alone; by a form or a header, which an article inside overrules; by a name with a word of its own.
_HARD, _ROUND, _SOFT = 1, 2, 4
_CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsbygoogle sponsor sponsors sponsored promo promos promotion banner banners nav navbar "
    "navigation menu menus breadcrumb breadcrumbs sidebar sidebars widget widgets related recommended recommendations share sharing sharebar social cookie cookies "
    "consent gdpr notice notices alert alerts popup popups modal newsletter newsletters subscribe subscription signup login comment comments commentlist disqus respond replies "
    "footer masthead pagination pager toolbar skip sitemap topbar".split()
)
#: Words that say where or in what a thing stands, not what it is.
_NEUTRAL = frozenset(
    "site page main global top bottom left right upper lower inner outer wrapper wrap container content area section block blocks slot slots zone col column row grid list lists item "
    "items link links icon icons button buttons bar box boxes group form primary secondary mobile desktop header head body title post posts article articles story stories entry text "
    "module component region panel card cards inline sticky fixed small large the of for wp js id view unit thread".split()
)
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
_MAIN_NAMES = frozenset("article post entry story maincontent articlebody".split())
_STATES = frozenset("has have no not non with without hide is layout".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEAD_TAGS = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())
_SELF_CLOSING = frozenset("p li dt dd tr td th".split())


def _chrome_named(value: str) -> int:
    """Whether a class or id value names chrome. A token of chrome names and neutral words only
    (site-footer, ad-slot) does by itself; one that ends in a chrome name behind a word of its own
    (lunch-menu) with less weight; has-sidebar and no-comments tell a state."""
    found = 0
    for token in value.split():
        parts = [part for part in _NAME.findall(token) if len(part) > 1]
        if parts and _STATES.isdisjoint(parts):
            names = [part in _CHROME_NAMES for part in parts]
            if any(names) and all(name or part in _NEUTRAL for name, part in zip(names, parts, strict=True)):
                # post-comments and comment-list are comments, but article-header and post-content are not chrome
                return _HARD
            if names[-1]:
                found = _SOFT
    return found


def blocks(page: str) -> list[tuple[int, int, int, str]]:
    """(level, chrome, soft, text) of the page's blocks in order. Level 2: inside article or main; 1: inside a part whose class or id
    says so; 0: neither. ``chrome`` is the sum of the reasons, ``soft`` numbers the outermost element that is chrome by a weak name."""
    out: list[tuple[int, int, int, str]] = []
    stack: list[tuple[str, int, int, int]] = []  # name, chrome so far, level so far, soft element
    open_names: dict[str, int] = {}
    buffer: list[str] = []
    softs = 0

    def flush() -> None:
        if buffer:
            chrome, level, soft = stack[-1][1:] if stack else (0, 0, 0)
            text = " ".join(entities.unescape("".join(buffer)).split())
            if text:
                out.append((level, chrome, soft, text))
            buffer.clear()

    def pop(depth: int) -> None:
        flush()
        for entry in stack[depth:]:
            open_names[entry[0]] -= 1
        del stack[depth:]

    last = 0
    for mark in _MARK.finditer(page):
        if mark.start() > last:
            buffer.append(page[last : mark.start()])
        last = mark.end()
        name = (mark[3] or mark[6] or "").lower()
        if not name:
            if mark[1] and mark[1].lower() in ("textarea", "select", "button"):
                buffer.append(" ")
            continue
        block = name in _BLOCKS
        if mark[2] or mark[5]:
            if block:
                flush()
            if open_names.get(name):
                depth = len(stack) - 1
                while stack[depth][0] != name and (name in _CONTAINERS or stack[depth][0] not in _CONTAINERS):
                    depth -= 1
                if stack[depth][0] == name:
                    pop(depth)
            continue
        if name == "br":
            buffer.append(" ")
        if name not in _HEAD_TAGS and open_names.get("head"):
            pop(next(i for i, entry in enumerate(stack) if entry[0] == "head"))
        if block:
            flush()
            if stack and stack[-1][0] in _SELF_CLOSING and (stack[-1][0] == name or stack[-1][0] == "p"):
                pop(len(stack) - 1)
        chrome, level, soft = stack[-1][1:] if stack else (0, 0, 0)
        named = 0
        attributes = mark[4] or mark[7] or ""
        if name == "form" or name == "header" and not level:
            named = _ROUND
        elif name in _CHROME_TAGS:
            named = _HARD
        elif name in ("article", "main"):
            level, chrome = 2, chrome & ~_ROUND
        if attributes and not attributes.isspace():
            seen: set[str] = set()
            for attribute in _ATTRIBUTE.finditer(attributes):
                kind = attribute[1].lower()
                if kind in seen:
                    continue
                seen.add(kind)
                value = (attribute[2] or attribute[3] or attribute[4] or "").lower()
                if kind == "role":
                    found = set(value.split())
                    named |= _HARD if found & _CHROME_ROLES else 0
                    if "main" in found:
                        level, chrome = 2, chrome & ~_ROUND
                elif kind == "hidden" or kind == "aria-hidden" and value.strip() == "true":
                    named |= _HARD
                elif kind in ("class", "id") and name not in ("body", "html"):
                    found = set(_NAME.findall(value))
                    named |= _chrome_named(value)
                    level = max(level, 1 if found & _MAIN_NAMES or found >= {"main", "content"} else 0)
        if named & _SOFT and not soft:
            softs += 1
            soft = softs
        if name not in _VOID and (name in _CONTAINERS or named or open_names.get(name)):
            if attributes.rstrip().endswith("/") and name not in _CONTAINERS:
                continue
            flush()
            stack.append((name, chrome | named, level, soft))
            open_names[name] = open_names.get(name, 0) + 1
            if level == 2 and not chrome | named:
                out.append((2, 0, 0, ""))  # a main part, though it may hold no text
    buffer.append(page[last:])
    flush()
    return out


def _parts(found: list[tuple[int, int, int, str]], level: int, mass: list[int], whole: list[int]) -> list[int] | None:
    """The blocks of the main part at ``level``, by number: a weakly named element inside goes unless it holds more
    than the rest, which counts as in ``whole``. None where there is no such part."""
    own = [i for i, (at, chrome, _, _) in enumerate(found) if at >= level and not chrome & (_HARD | _ROUND)]
    plain = [i for i in own if not found[i][1]]
    rest = sum(whole[i] for i in plain)
    heavy = {k for k in {found[i][2] for i in own} - {0} if sum(mass[i] for i in own if found[i][2] == k) > rest}
    kept = [i for i in own if not found[i][1] or found[i][2] in heavy]
    return kept or None


def is_decided(found: list[tuple[int, int, int, str]]) -> bool:
    """Whether the page has an article or main part and no plain text around it."""
    return any(at == 2 and not chrome for at, chrome, _, _ in found) and not any(at < 2 and not chrome for at, chrome, _, _ in found)


def is_settled(found: list[tuple[int, int, int, str]]) -> bool:
    """Whether markup decides the page whatever the array finds: no weakly named element in its main part has to be weighed."""
    return is_decided(found) and not any(soft and at == 2 and not chrome & (_HARD | _ROUND) for at, chrome, soft, _ in found)


def choose(found: list[tuple[int, int, int, str]], unique: list[str] | None = None) -> tuple[bool, list[int]]:
    """(whether a main part was chosen, numbers of the blocks to keep). ``unique`` has what the array
    leaves of each block; without it all counts."""
    left = [text for *_, text in found] if unique is None else unique
    mass = [len(text.split()) for text in left]
    # what stays whole counts whole
    whole = [len(text.split()) for *_, text in found] if is_decided(found) else mass
    for level in (2, 1):
        part = _parts(found, level, mass, whole)
        if part is not None:
            held = set(part)
            around = sum(m for i, m in enumerate(mass) if i not in held and not found[i][1])
            if sum(mass[i] for i in part) >= around:
                return True, part
    return False, _parts(found, 0, mass, mass) or []


def main_text(page: str) -> tuple[str | None, list[str]]:
    """The text of the page's main part by markup alone, or None and the blocks to decide on."""
    found = blocks(page)
    chosen, kept = choose(found)
    texts = [found[i][3] for i in kept if found[i][3]]
    return ("\n".join(texts), []) if chosen else (None, texts)


def _page(found: list[tuple[int, int, int, str]]) -> int:
    """The hash of all text of a page."""
    name = hashlib.blake2b("\n".join(text for *_, text in found if text).encode("utf-8", "surrogatepass"), digest_size=8)
    return int.from_bytes(name.digest(), "little", signed=True)


def read_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, host, page (hash of all its text), main (text of the main part where markup settles it, else null),
    tokens (their number), and of the other pages blocks, levels, chromes and softs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for html in batch["html"]:
                found = blocks(html)
                settled = is_settled(found)
                main = "\n".join(found[i][3] for i in choose(found)[1] if found[i][3]) if settled else None
                size = sum(text.count(" ") + 1 for *_, text in found if text)
                levels, chromes, softs, held = ([], [], [], []) if settled or not found else map(list, zip(*found, strict=True))
                rows.append((_page(found), main, size, held, levels, chromes, softs))
            out = pd.DataFrame(rows, columns=["page", "main", "tokens", "blocks", "levels", "chromes", "softs"])
            for name in ("host", "url", "page_id"):
                out.insert(0, name, batch[name].to_numpy())
            yield out

    fields = "url string, host string, page long, main string, tokens int, blocks array<string>, levels array<int>, chromes array<int>, softs array<int>"
    return map_rows(pages.select("page_id", "url", "host", "html"), "page_id", run, fields)


def _decide(pages: DataFrame) -> DataFrame:
    """page_id, url, text of pages (blocks, levels, chromes, softs, covered: ranges of tokens or null)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for held, levels, chromes, softs, covered in zip(*(batch[c] for c in ("blocks", "levels", "chromes", "softs", "covered")), strict=True):
                found = list(zip(levels, chromes, softs, held, strict=True))
                gone = {p for r in ([] if covered is None else covered) for p in range(r["from"], r["to"])}
                unique, at = [], 0
                for text in held:
                    words = text.split(" ") if text else []
                    unique.append(" ".join(w for k, w in enumerate(words, at) if k not in gone))
                    at += len(words)
                chosen, kept = choose(found, unique)
                texts.append("\n".join(t for i in kept if (t := held[i] if chosen else unique[i])))
            out = pd.DataFrame({"text": texts})
            out.insert(0, "url", batch["url"].to_numpy())
            out.insert(0, "page_id", batch["page_id"].to_numpy())
            yield out

    slim = pages.select("page_id", "url", "blocks", "levels", "chromes", "softs", "covered")
    return map_rows(slim, "page_id", run, "url string, text string")


#: Where a token stands: in plain text, in chrome by its tag, role or name alone, or in a main part without plain text around it.
_PLAIN, _CHROME, _MAIN = 0, 1, 2


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def run_hashes(hosts: list[str], tokens: list[list[str]], run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the page, position, hash) of every run of ``run`` tokens, pages in order. The host goes into the hash."""
    flat = list(chain.from_iterable(tokens))
    n = len(flat) - run + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = hash_array(np.array(flat, object))
    total = np.zeros(n, np.uint64)
    for j, key in enumerate(_mixed(np.arange(1, run + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)):
        part = words[j : j + n] * key
        total += part ^ (part >> np.uint64(32))
    sizes = np.array([len(t) for t in tokens], np.int64)
    owner = np.repeat(np.arange(len(tokens)), sizes)
    at = np.flatnonzero(owner[:n] == owner[run - 1 :])
    page = owner[at]
    hashes = _mixed(total[at] + hash_array(np.array(hosts, object))[page]) >> np.uint64(64 - BITS)
    return page, at - (np.cumsum(sizes) - sizes)[page], hashes


def _packed(hashes: np.ndarray) -> bytes:
    """Sorted hashes as steps, byte planes first: steps are small in a large bundle."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 8 * n, "zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).ravel(), dtype=np.uint64)


class Bundle:
    """Runs of pages, sorted and dealt into ranges of hashes."""

    FIELDS = "range int, main boolean, n int, hashes binary, flags binary, pages binary"

    def __init__(self, ranges: int):
        self.ranges, self.size, self.parts = ranges, 0, []

    def add(self, hashes: np.ndarray, pages: np.ndarray, alone: np.ndarray, roles: np.ndarray) -> None:
        """Runs with their page's hash, whether no other row has that page, and their role."""
        self.parts.append((hashes, pages, alone, roles))
        self.size += len(hashes)

    def close(self) -> pd.DataFrame:
        """A row per range, place (main part or outside) and kind of page. A run has one entry with the number of its pages, at most 100
        (flags / 2), and whether it stands in chrome (flag 1); of pages that other rows may have too, an entry for each page with the page."""
        hashes, pages, alone, roles = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        self.size, self.parts = 0, []
        rows = []
        for main in (False, True):
            for named in (False, True):
                here = ((roles == _MAIN) == main) & (alone != named)
                if not here.any():
                    continue
                h, p, chrome = hashes[here], pages[here], roles[here] == _CHROME
                order = np.lexsort((p, h)) if named else np.argsort(h, kind="stable")  # a page's runs stand together, so they do in equal hashes
                h, p, chrome = h[order], p[order], chrome[order]
                new_hash = np.concatenate([[True], h[1:] != h[:-1]])
                new = new_hash | np.concatenate([[True], p[1:] != p[:-1]])
                first = np.flatnonzero(new if named else new_hash)
                flags = np.minimum(np.add.reduceat(new, first, dtype=np.int64), 100) << 1 | np.logical_or.reduceat(chrome, first)
                h, p = h[first], p[first]
                ends = np.searchsorted(h, (np.arange(self.ranges + 1, dtype=object) * 2**BITS // self.ranges).astype(np.uint64))
                for r in np.flatnonzero(np.diff(ends)):
                    a, b = ends[r], ends[r + 1]
                    held = pa.compress(p[a:b].tobytes(), "zstd", asbytes=True) if named else None
                    rows.append((r, main, b - a, _packed(h[a:b]), pa.compress(flags[a:b].astype(np.uint8).tobytes(), "zstd", asbytes=True), held))
        return pd.DataFrame(rows, columns=["range", "main", "n", "hashes", "flags", "pages"])


def _among(runs: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which of the runs are in ``found``, which is sorted and shorter."""
    if not len(found):
        return np.zeros(len(runs), bool)
    return found[np.minimum(np.searchsorted(found, runs), len(found) - 1)] == runs


def _met(rows: pd.DataFrame, asked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, number of its pages, at most 100 a bundle; whether it stands in chrome) of a range's bundles, in order; only of the runs in
    ``asked``, if given."""
    hashes, counts, chromes, named = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)], []
    for n, packed, flags, pages in zip(rows["n"], rows["hashes"], rows["flags"], rows["pages"], strict=True):
        h, flag = _unpacked(packed, n), np.frombuffer(pa.decompress(flags, n, "zstd", asbytes=True), np.uint8)
        here = slice(None) if asked is None else _among(h, asked)
        h, flag = h[here], flag[here]
        if pages is None:
            hashes.append(h), counts.append((flag >> 1).astype(np.int64)), chromes.append(flag & 1 == 1)
        else:
            named.append((h, np.frombuffer(pa.decompress(pages, 8 * n, "zstd", asbytes=True), np.int64)[here], flag & 1 == 1))
    if named:  # a page that several bundles have counts once
        h, p, chrome = (np.concatenate(c) for c in zip(*named, strict=True))
        order = np.lexsort((p, h))
        h, p, chrome = h[order], p[order], chrome[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (p[1:] != p[:-1])])[: len(h)]
        hashes.append(h[new]), counts.append(np.ones(new.sum(), np.int64)), chromes.append(chrome[new])
    h, count, chrome = np.concatenate(hashes), np.concatenate(counts), np.concatenate(chromes)
    if not len(h):
        return h, count, chrome
    order = np.argsort(h)
    h, count, chrome = h[order], count[order], chrome[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[first], np.add.reduceat(count, first), np.logical_or.reduceat(chrome, first)


def repeated_runs(bundles: DataFrame, ranges: int) -> DataFrame:
    """(run, home): the hashes of boilerplate, and of text that is at home elsewhere (see above)."""

    def own(rows: pd.DataFrame) -> pd.DataFrame:
        h, count, chrome = _met(rows[~rows["main"]])
        homes, pages, _ = _met(rows[rows["main"]], h)
        home = _among(h, homes[pages == 1]) & ~chrome & (count <= VERSIONS)
        found = home | (count > 1)
        return pd.DataFrame({"run": h[found].astype(np.int64), "home": home[found]})

    return bundles.repartitionById(ranges, "range").groupBy("range").applyInPandas(own, "run long, home boolean")


def _ranges(tokens: int) -> int:
    return max(RANGES, math.ceil(tokens / RANGE_RUNS))


def bundle_pages(pages: DataFrame, ranges: int, copies: list[int] | None, run: int) -> DataFrame:
    """The bundles of all pages (host, html). ``copies`` has the pages that several rows may have, None all."""
    listed = None if copies is None else np.array(copies, np.int64)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle = Bundle(ranges)
        for batch in batches:
            held, names, sizes, roles = [], [], [], []
            for html in batch["html"]:
                found = blocks(html)
                decided = is_decided(found)
                words = [text.split(" ") if text else [] for *_, text in found]
                held.append(list(chain.from_iterable(words)))
                names.append(_page(found))
                sizes += map(len, words)
                roles += [_MAIN if decided and level == 2 and not chrome else _CHROME if chrome & _HARD else _PLAIN for level, chrome, _, _ in found]
            page, at, hashes = run_hashes(batch["host"].tolist(), held, run)
            start = np.cumsum([0, *map(len, held)])[:-1][page] + at
            role = np.repeat(np.array(roles, np.int64), np.array(sizes, np.int64))
            among = lambda kind: np.diff(np.cumsum(np.concatenate([[0], role == kind]))[np.stack([start, start + run])], axis=0)[0] if len(start) else start  # noqa: B023, E731
            main, chrome = among(_MAIN), among(_CHROME)
            within = (main == 0) | (main == run)  # no run reaches across the border of a main part
            name = np.array(names, np.int64)
            alone = np.zeros(len(name), bool) if listed is None else ~np.isin(name, listed)
            kind = np.where(main == run, _MAIN, np.where(chrome == run, _CHROME, _PLAIN)).astype(np.uint8)
            bundle.add(hashes[within], name[page][within], alone[page][within], kind[within])
            if bundle.size >= BUNDLE_RUNS:
                yield bundle.close()
        if bundle.size:
            yield bundle.close()

    return pages.select("host", "html").mapInPandas(deal, Bundle.FIELDS)


def run_starts(streams: DataFrame, repeated: DataFrame, run: int) -> DataFrame:
    """(host, page, starts, homes): where the repeated runs of streams (host, page, tokens) start, and those at home elsewhere."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            page, at, hashes = run_hashes(batch["host"].tolist(), [list(t) for t in batch["tokens"]], run)
            yield pd.DataFrame({"host": batch["host"].to_numpy()[page], "page": batch["page"].to_numpy()[page], "pos": at, "run": hashes.astype(np.int64)})

    runs = streams.select("host", "page", "tokens").mapInPandas(deal, "host string, page long, pos int, run long")
    at = lambda home: F.array_sort(F.collect_set(F.when(F.col("home") == home, F.col("pos"))))
    return runs.join(repeated, "run").groupBy("host", "page").agg(at(False).alias("starts"), at(True).alias("homes"))


def host_boilerplate(streams: DataFrame, run: int = RUN) -> DataFrame:
    """(host, page, covered): ranges (from, to) of the tokens that lie in substrings of
    at least ``run`` tokens which distinct pages of a host share. ``streams`` has
    host, page (pages with one hash are one page) and the starts of such runs, and of those whose tokens
    stay; or tokens and no starts: then its own rows are the array, all outside of main parts."""
    starts = streams
    if "starts" not in streams.columns:

        def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                page, _, hashes = run_hashes(batch["host"].tolist(), [list(t) for t in batch["tokens"]], run)
                if len(hashes):
                    bundle = Bundle(ranges)
                    bundle.add(hashes, batch["page"].to_numpy()[page], np.zeros(len(page), bool), np.full(len(page), _PLAIN, np.uint8))
                    yield bundle.close()

        ranges = _ranges(streams.agg(F.sum(F.size("tokens"))).first()[0] or 0)
        bundles = streams.select("host", "page", "tokens").mapInPandas(deal, Bundle.FIELDS)
        starts = run_starts(streams, materialize(repeated_runs(bundles, ranges), "boilerplate-runs"), run)
    first = F.filter("starts", lambda s, i: (i == 0) | (s > F.get("starts", i - 1) + run))
    last = F.filter("starts", lambda s, i: (i == F.size("starts") - 1) | (F.get("starts", i + 1) > s + run))
    covered = F.zip_with(first, last, lambda s, e: F.struct(s.alias("from"), (e + run).alias("to")))
    tokens = lambda ranges: F.flatten(F.transform(ranges, lambda r: F.sequence(r["from"], r["to"] - 1)))
    homes = F.transform("homes", lambda s: F.struct(s.alias("from"), (s + run).alias("to")))
    left = F.transform(F.array_except(tokens(covered), tokens(homes)), lambda p: F.struct(p.alias("from"), (p + 1).alias("to")))
    return starts.select("host", "page", F.when(F.size("homes") == 0, covered).otherwise(left).alias("covered"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", run: int = RUN) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    A null or empty html gives the empty text; a null url is the host ''. Repeated
    rows are read each on its own; pages whose texts are equal are one page to
    the suffix array and don't make each other boilerplate. No rows give no rows;
    other columns are not read.
    """
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][\w+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1), F.lit("")))
    slim = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    ).withColumn("host", host)
    read = read_pages(slim)
    # texts of settled pages are neither written nor shuffled: those pages are read again
    settled = read.where("main is not null").select("page_id", "url", F.col("main").alias("text"))
    of_open = lambda name: F.when(F.col("main").isNull(), F.col(name)).alias(name)
    narrow = ["page_id", "url", "blocks", "levels", "chromes", "softs"]
    streams = materialize(read.select("host", "page", "tokens", F.col("main").isNull().alias("open"), *map(of_open, narrow)), "page-streams")
    ranges = _ranges(streams.agg(F.sum("tokens")).first()[0] or 0)
    twice = streams.groupBy(F.xxhash64("host"), "page").count().where("count > 1").select("page").limit(COPIES + 1).toPandas()["page"].tolist()
    bundles = bundle_pages(slim, ranges, twice if len(twice) <= COPIES else None, run)
    open_pages = streams.where("open")
    words = F.flatten(F.transform(F.filter("blocks", lambda b: b != ""), lambda b: F.split(b, " ")))
    tokens = open_pages.select("host", "page", words.alias("tokens")).dropDuplicates(["host", "page"])
    with rows_per_batch(pages.sparkSession, BATCH_PAGES):
        repeated = materialize(repeated_runs(bundles, ranges), "boilerplate-runs")
        found = materialize(host_boilerplate(run_starts(tokens, repeated, run), run), "boilerplate")
    both = settled.unionByName(_decide(open_pages.join(found, ["host", "page"], "left")))
    return both.withColumn("n_chars", F.char_length("text").cast("long"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
