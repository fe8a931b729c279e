"""Main text of web pages: blocks of markup, and a suffix array over each host's pages.

A page becomes a list of text blocks (what stands between block-level tags), without scripts,
styles, comments and other parts that no reader sees. Each block knows whether it lies in page
furniture (``nav``, ``footer``, ``aside``, forms, elements whose class or id names an advert, a
notice, comments and so on) and whether it lies in the article (``article``, ``main``).

A class or id names furniture as a whole or by its leading token, after words of place ("sidebar",
"sidebar-left", "site-footer", not "with-sidebar"). A name alone is judged once its element's
content is known: an element that encloses ``main``, or an article of a page whose articles all lie
in such elements, is a wrapper and no furniture.

Furniture goes. So does, outside the article, what the host repeats on a clear share of its pages:
on ``SHARE`` of its distinct pages with words outside articles, two at least. That is a whole block,
or blocks in a row, of ``REPEAT`` words or more; and a run of ``LONG`` words or more within a text,
found by a suffix array with the common lengths of neighbouring suffixes over the words outside the
articles of a host's pages, furniture included. A phrase that pages share within their sentences
stays, and so does what is unique; unique adverts and menus are known by their markup alone.

Within articles the same suffix array looks for runs of ``LONG`` words, with more evidence asked: a
share ``INSIDE_SHARE`` of the host's different articles, ``INSIDE_LEAST`` at least. Articles of equal
text count once, and a page keeps all of an article of which such runs make up ``CONTENT`` or more: it is
a copy of an article then, with little of its own, and the run is its content. Not all words of all
articles are gathered for that. Every run of LONG words has a seed, the least hash of its runs of
``SEED`` words. Seeds are counted by host; only stretches around those that enough articles hold (they
hold every run asked for) go to the suffix array.

A host of more than ``HOST_PAGES`` such pages, or ``HOST_WORDS`` words in them, is not gathered: a word
lies in a repeated run of at least LONG words exactly if it lies in one of LONG words, so there blocks
and runs of LONG words are counted by host, reduced in each task before the shuffle, and joined back
with a salt.

Defined results: NULL or empty html gives an empty text; a page without article and without
repeated runs keeps all its unfurnished blocks; rows that repeat a page are pages of their own, but
the same page twice (equal page_id and url) is no evidence of repetition; a NULL url forms a host of
its own; further columns pass through.
"""

from __future__ import annotations

import re
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.llm import common as C

#: Words of a repeated block, or of short blocks in a row, and of a repeated run within a text.
REPEAT = 4
LONG = 24
#: Share of a host's distinct pages that must hold what counts as repeated.
SHARE = 0.1
#: The same within articles: share and least number of a host's different articles, and the share of an
#: article's words from which repeated runs are its content.
INSIDE_SHARE = 0.25
INSIDE_LEAST = 5
CONTENT = 0.5
SEED = 8
#: Pages of a host, and words in them, that one task works on.
HOST_PAGES = 2000
HOST_WORDS = 1 << 20
SALTS = 16
#: Hosts and seeds within their articles that are broadcast at most.
BROADCAST_HOSTS = 20_000
BROADCAST_SEEDS = 1 << 20
#: Pages with repeated words whose marks are broadcast at most.
BROADCAST_PAGES = 20_000

# HTML's elements by what they mean for the text.
UNSEEN = frozenset("head script style noscript template title svg math canvas iframe object embed audio video select option datalist textarea button".split())
FURNITURE = frozenset("nav footer aside form menu dialog".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li legend main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(("article", "main"))
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices popup modal newsletter subscribe signup"
    " nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside widget related share sharing social comment comments reply replies disqus header masthead topbar login search".split()
)
PLACES = frozenset("site page main global primary secondary top bottom left right".split())
SIBLINGS = frozenset("li dt dd tr td th".split())
WHOLE = frozenset("html body article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title noscript iframe".split())
_NAME = re.compile(r"[A-Za-z0-9]+")
_MARKUP = re.compile(r"<(?=!|\?|/?[A-Za-z])")
#: A quote matters only as the start of an attribute's value.
_TAG = re.compile(r"""<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
_PLAIN_TAG = re.compile(r"<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>[^>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


def _furniture_name(name: str) -> bool:
    """Whether a class or id names furniture: its first token does that is no word of place."""
    tokens = [w.lower() for w in _NAME.findall(name)]
    return next((w for w in tokens if w not in PLACES), "") in FURNITURE_NAMES


class _Blocks:
    """Collects (text, in furniture, in article) for each block of a page."""

    def __init__(self) -> None:
        # Of each open element: tag, unseen, furniture, article, innermost named element, and the
        # place of the innermost block (itself included).
        self.open: list[tuple[str, bool, bool, bool, int, int]] = []
        self.places: dict[str, list[int]] = {}  # of the open elements of each tag
        self.parts: list[str] = []
        self.found: list[tuple[str, bool, bool, int]] = []
        # Of each element with a furniture name: whether it encloses an article, and main, and the
        # named element around it.
        self.named: list[list] = []
        self.free = False  # whether an article lies in no furniture

    def state(self) -> tuple[bool, bool, bool, int]:
        return self.open[-1][1:5] if self.open else (False, False, False, -1)

    def blocks(self) -> list[tuple[str, bool, bool]]:
        apart: list[bool] = []
        for article, main, around in self.named:
            apart.append(not (main or (article and not self.free)) or (around >= 0 and apart[around]))
        return [(text, furniture or (named >= 0 and apart[named]), article) for text, furniture, article, named in self.found]

    def leave(self, at: int) -> None:
        """Close the open elements from a place on."""
        for tag, *_ in self.open[at:]:
            self.places[tag].pop()
        del self.open[at:]

    def flush(self) -> None:
        if not self.parts:
            return
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            _, furniture, article, named = self.state()
            self.found.append((text, furniture, article, named))

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self.flush()
            self._close_implied(tag)
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        unseen, furniture, article, within = self.state()
        given = {k.lower(): unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(attributes)} if attributes else {}
        names = [name for a in ("class", "id") for name in given.get(a, "").split()]
        hidden = "hidden" in given or given.get("aria-hidden", "").lower() == "true" or "display:none" in given.get("style", "").replace(" ", "").lower()
        apart = tag in FURNITURE or (tag == "header" and not article) or given.get("role", "").lower() in FURNITURE_ROLES
        unseen, furniture = unseen or tag in UNSEEN or hidden, furniture or apart
        if any(map(_furniture_name, names)) and tag not in WHOLE and not (tag in HEADINGS and article):
            self.named.append([False, False, within])
            within = len(self.named) - 1
        if tag in ARTICLE and not unseen and not furniture:
            around, kind = within, int(tag == "main")
            # What encloses a marked element is marked as well.
            while around >= 0 and not self.named[around][kind]:
                self.named[around][kind] = True
                around = self.named[around][2]
            self.free = self.free or within < 0
        block = len(self.open) if tag in BLOCKS else self.open[-1][5] if self.open else -1
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, unseen, furniture, article or tag in ARTICLE, within, block))

    def _close_implied(self, tag: str) -> None:
        """A paragraph ends where the next block begins, a list item or cell where its like does."""
        at = self.open[-1][5] if self.open else -1
        if at >= 0 and ((name := self.open[at][0]) == "p" or (name == tag and tag in SIBLINGS)):
            self.leave(at)

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        places = self.places.get(tag)
        # An inline end tag doesn't close the blocks around it.
        if places and (tag in BLOCKS or places[-1] > self.open[-1][5]):
            self.leave(places[-1])

    def text(self, data: str) -> None:
        if not self.state()[0]:
            self.parts.append(unescape(data) if "&" in data else data)


def page_blocks(html: str) -> list[tuple[str, bool, bool]]:
    """The text blocks of a page in order: text, whether in furniture, whether in the article."""
    page, at, pattern = _Blocks(), 0, _TAG
    while at < len(html):
        opening = _MARKUP.search(html, at)
        start = opening.start() if opening else len(html)
        if start > at:
            page.text(html[at:start])
        if opening is None:
            break
        if html[start + 1] in "!?":
            # A comment or a declaration; an open comment hides the rest.
            mark = "-->" if html.startswith("<!--", start) else ">"
            close = html.find(mark, start + (4 if mark == "-->" else 2))
            if close < 0 and mark == ">":
                page.text(html[start:])
            at = close + len(mark) if close >= 0 else len(html)
            continue
        tag = pattern.match(html, start)
        if tag is None and pattern is _TAG:
            # No end outside quotes: from here on tags end at the next ">", so a page is read once.
            pattern = _PLAIN_TAG
            tag = pattern.match(html, start)
        if tag is None:
            page.text(html[start:])
            break
        at = tag.end()
        name = tag["name"].lower()
        if tag["close"]:
            page.end(name)
            continue
        page.start(name, tag["rest"])
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
            body = html[at : close.start()] if close else html[at:]
            page.text(body)
            at = close.start() if close else len(html)
    page.flush()
    return page.blocks()


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted suffixes of a stream of numbers, and the common length of each with the one before
    it. Suffixes are ranked by their first 1, 2, 4, ... tokens until all differ."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        after = np.full(n, -1, np.int64)
        after[: max(0, n - width)] = rank[width:]
        order = np.lexsort((after, rank))
        new = np.r_[False, (rank[order[1:]] != rank[order[:-1]]) | (after[order[1:]] != after[order[:-1]])]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if width >= n or rank[order[-1]] == n - 1:
            break
        width *= 2
    common, length = np.zeros(n, np.int64), 0
    place, stream, sorted_ = rank.tolist(), tokens.tolist(), order.tolist()
    for i in range(n):
        if place[i] == 0:
            length = 0
            continue
        j = sorted_[place[i] - 1]
        while i + length < n and j + length < n and stream[i + length] == stream[j + length]:
            length += 1
        common[place[i]] = length
        length = max(0, length - 1)
    return order, common


def repeated_words(pages: list[list[str]], names: list, least: int = REPEAT, need: int = 2) -> list[np.ndarray]:
    """For each page, which of its words lie in a run of ``least`` words that ``need`` pages have.

    Pages are told apart by ``names``. Each page ends in a token of its own, so no run spans two.
    """
    vocabulary: dict[str, int] = {}
    sizes = [len(p) for p in pages]
    tokens = np.empty(sum(sizes) + len(pages), np.int64)
    at = 0
    for k, page in enumerate(pages):
        for word in page:
            tokens[at] = vocabulary.setdefault(word, len(vocabulary))
            at += 1
        tokens[at] = -1 - k
        at += 1
    begin = np.r_[0, np.cumsum(np.array(sizes, np.int64) + 1)]
    if not len(tokens):
        return []
    numbers = {name: k for k, name in enumerate(dict.fromkeys(names))}
    page_of = np.repeat(np.array([numbers[n] for n in names]), np.diff(begin))
    order, common = suffix_array(tokens)
    # Suffixes that share their first ``least`` tokens stand together.
    group = np.cumsum(common < least)
    owner = page_of[order]
    held = np.unique(group * len(numbers) + owner) // len(numbers)
    pages_of = np.bincount(held, minlength=group[-1] + 1)
    edge = np.zeros(len(tokens) + least + 1, np.int64)
    starts = order[(pages_of >= need)[group]]
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + least, -1)
    covered = np.cumsum(edge)[: len(tokens)] > 0
    return [covered[begin[k] : begin[k + 1] - 1] for k in range(len(pages))]


LOOSE = "page_id long, mark long, name long, host string, words array<string>, judged array<boolean>, units array<struct<at:int,size:int,key:long>>, article long, seeds array<long>"
UNITS = pa.list_(pa.struct([("at", pa.int32()), ("size", pa.int32()), ("key", pa.int64())]))
#: ``at`` is -1 outside articles, and within them the place of the stretch in the article.
STRETCH = "page_id long, mark long, name long, host string, words array<string>, judged array<boolean>, units array<struct<at:int,size:int,key:long>>, at int, need long"
MARKS = "page_id long, mark long, at int, positions array<int>"


def host_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", -1)
    return F.coalesce(F.lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))


def _zones(html: str) -> tuple[list[str], list[bool], list[tuple[int, int, int]], str]:
    """The words of a page outside its article, whether each is judged by repetition (those in
    furniture go anyway, but tell what the host repeats), and its units: from each block as many
    blocks as make REPEAT words (place, number of words, hash); and the text of its article."""
    words, judged, ends, units, inside = [], [], [0], [], []
    for text, furniture, article in page_blocks(html):
        if article and not furniture:
            inside.append(text)
            continue
        found = text.split(" ")
        words += found
        judged += [not furniture] * len(found)
        ends.append(len(words))
    for k, at in enumerate(ends[:-1], 1):
        end = next((e for e in ends[k:] if e - at >= REPEAT), None)
        if end is not None:
            units.append((at, end - at, _key("\n".join(words[at:end]))))
    return words, judged, units, " ".join(inside)


def _key(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def run_seeds(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The seed of each run of LONG words of the texts, the row it lies in, and the place of its first
    word in that row."""
    raw, offsets = C.text_bytes(texts)
    starts, ends, first = C.find_words(raw, offsets, C.SPACED)
    if len(starts) < LONG:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = C.window_hashes(C.hash_spans(raw, starts, ends), SEED)
    least = np.lib.stride_tricks.sliding_window_view(hashes, LONG - SEED + 1).min(axis=1)
    row = C.rows_of(first)
    at = np.flatnonzero(row[: len(least)] == row[LONG - 1 :])
    return C.signed(least[at]), row[at], at - first[row[at]]


def pages_needed(pages: int) -> int:
    """The pages that must hold what a host of so many pages repeats."""
    return max(2, int(np.ceil(SHARE * pages)))


def repeated_units(units: list[list[tuple[int, int, int]]], names: list, sizes: list[int], need: int) -> list[np.ndarray]:
    """For each page, which of its words lie in a unit that ``need`` pages have."""
    held: dict[int, set] = {}
    for page, name in zip(units, names):
        for _, _, key in page:
            held.setdefault(key, set()).add(name)
    out = [np.zeros(n, bool) for n in sizes]
    for hit, page in zip(out, units):
        for at, size, key in page:
            if len(held[key]) >= need:
                hit[at : at + size] = True
    return out


def main_text(html: str, repeated: set[int], inside: set[int] = frozenset()) -> str:
    """The text of a page without furniture and without the repeated words outside the article and
    within it (by their place among the words outside, and among the article's)."""
    blocks, out, places = page_blocks(html), [], [0, 0]
    if inside:
        size = sum(text.count(" ") + 1 for text, furniture, article in blocks if article and not furniture)
        inside = inside if len(inside) < CONTENT * size else ()
    for text, furniture, article in blocks:
        zone = int(article and not furniture)
        gone, at, words = (repeated, inside)[zone], places[zone], text.split(" ")
        if not furniture:
            kept = [w for k, w in enumerate(words, at) if k not in gone] if gone else words
            if kept:
                out.append(" ".join(kept))
        places[zone] += len(words)
    return " ".join(out)


def _loose(pages: DataFrame) -> DataFrame:
    """The words outside articles of (page_id, mark, name, host, html), a hash of the article and the
    different seeds of its runs."""
    names = [c.split()[0] for c in LOOSE.split(", ")]

    def run(batches):
        for batch in batches:
            column = batch.column(4)
            for i, j in C.row_slices(C.text_bytes(column)[1]):
                found = [_zones(x.as_py() or "") for x in column[i:j]]
                units = [[dict(zip(("at", "size", "key"), u)) for u in f[2]] for f in found]
                lists = [pa.array([f[0] for f in found], pa.list_(pa.string())), pa.array([f[1] for f in found], pa.list_(pa.bool_())), pa.array(units, UNITS)]
                seeds, row, _ = run_seeds(pa.array([f[3] for f in found], pa.string()))
                each = np.unique(np.stack([row, seeds], axis=1), axis=0)
                own = C.list_array(pa.array(each[:, 1]), np.bincount(each[:, 0], minlength=j - i))
                articles = pa.array([_key(f[3]) for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays([*[c[i:j] for c in batch.columns[:4]], *lists, articles, own], names)

    return C.with_workers(pages).mapInArrow(run, LOOSE).where((F.size("words") >= REPEAT) | (F.size("seeds") > 0))


def _host_seeds(loose: DataFrame) -> DataFrame:
    """(host, need, seeds): the seeds that enough of the host's different articles hold. They are no
    more than 1 / INSIDE_SHARE articles of the host have on average."""
    articles = C.checkpointed(loose.where(F.size("seeds") > 0).select("host", "article", "seeds").dropDuplicates(["host", "article"]))
    number = articles.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") >= INSIDE_LEAST)
    need = number.select("host", F.greatest(F.lit(INSIDE_LEAST), F.ceil(F.lit(INSIDE_SHARE) * F.col("n"))).cast("long").alias("need"))
    held = articles.select("host", F.explode("seeds").alias("seed")).groupBy("host", "seed").agg(F.count("*").alias("n")).where(F.col("n") >= INSIDE_LEAST)
    enough = C.checkpointed(held).join(need, "host").where("n >= need")
    return C.checkpointed(enough.groupBy("host").agg(F.max("need").alias("need"), F.collect_list("seed").alias("seeds")))


def _stretches(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """The stretches of articles (page_id, mark, name, host, html) around the seeds of their hosts, each
    as a page of its own; ``name`` tells articles apart."""
    size = wanted.agg(F.count("*").alias("hosts"), F.sum(F.size("seeds")).alias("seeds")).head()
    if size["hosts"] <= BROADCAST_HOSTS and size["seeds"] <= BROADCAST_SEEDS:
        asked = source.join(F.broadcast(wanted), "host")
    else:
        salted = wanted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        asked = source.withColumn("salt", F.pmod("mark", F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"])
    names = [c.split()[0] for c in STRETCH.split(", ")]

    def run(batches):
        for batch in batches:
            column, known = batch.column(3), batch.column(5)
            for i, j in C.row_slices(C.text_bytes(column)[1]):
                texts = [_zones(x.as_py() or "")[3] for x in column[i:j]]
                seeds, row, place = run_seeds(pa.array(texts, pa.string()))
                rows, begins, parts = [], [], []
                for k in range(j - i):
                    a, b = np.searchsorted(row, (k, k + 1))
                    at = place[a:b][np.isin(seeds[a:b], known[i + k].values.to_numpy())]
                    if len(at):
                        words = texts[k].split(" ")
                        cut = np.flatnonzero(np.diff(at) > LONG) + 1
                        for run in np.split(at, cut):
                            rows.append(i + k)
                            begins.append(int(run[0]))
                            parts.append(words[run[0] : run[-1] + LONG])
                taken = pa.array(rows, pa.int64())
                articles = pa.array([_key(texts[k - i]) for k in rows], pa.int64())
                lists = [pa.array(parts, pa.list_(pa.string())), pa.array([[True] * len(p) for p in parts], pa.list_(pa.bool_())), pa.array([[]] * len(rows), UNITS)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c).take(taken) for c in (0, 1)], articles, batch.column(2).take(taken), *lists, pa.array(begins, pa.int32()), batch.column(4).take(taken)], names)

    # No host has this name, so stretches are only compared with each other.
    return C.with_workers(asked).select("page_id", "mark", F.concat("host", F.lit("#article")).alias("host"), "html", "need", "seeds").mapInArrow(run, STRETCH)


def _by_host(loose: DataFrame) -> DataFrame:
    """Places of judged words that their host repeats; pages arrive sorted by host."""

    def found(table: pa.Table) -> pa.RecordBatch:
        hosts = table["host"].to_pylist()
        words, judged, names = (table[c].to_pylist() for c in ("words", "judged", "name"))
        units = [[(u["at"], u["size"], u["key"]) for u in page] for page in table["units"].to_pylist()]
        needed, begins = table["need"].to_pylist(), table["at"].to_pylist()
        rows, places, first = [], [], 0
        while first < len(hosts):
            last = first
            while last < len(hosts) and hosts[last] == hosts[first]:
                last += 1
            own, need = names[first:last], needed[first]
            runs = repeated_words(words[first:last], own, LONG, need)
            blocks = repeated_units(units[first:last], own, [len(w) for w in words[first:last]], need)
            for k, (run, block) in enumerate(zip(runs, blocks), first):
                if len(at := np.flatnonzero((run | block) & np.array(judged[k], bool))):
                    rows.append(k)
                    places.append((at + max(0, begins[k])).astype(np.int32))
            first = last
        taken = table.take(pa.array(rows, pa.int64()))
        return pa.RecordBatch.from_arrays([*[taken[c].combine_chunks() for c in ("page_id", "mark", "at")], pa.array(places, pa.list_(pa.int32()))], ["page_id", "mark", "at", "positions"])

    def run(batches):
        held = None
        for batch in batches:
            for first in range(0, batch.num_rows, HOST_PAGES):
                table = pa.Table.from_batches([batch.slice(first, HOST_PAGES)])
                held = table if held is None else pa.concat_tables([held, table])
                host = held["host"].to_pylist()
                done = host.index(host[-1])
                if done:
                    yield found(held.slice(0, done))
                    held = held.slice(done)
        if held is not None and held.num_rows:
            yield found(held)

    return C.with_workers(loose).repartition("host").sortWithinPartitions("host").mapInArrow(run, MARKS)


def _by_count(loose: DataFrame) -> DataFrame:
    """The same for hosts of very many pages or words: units and runs of LONG words are counted, not
    gathered."""
    last = F.size("words") - LONG + 1
    grams = F.transform(F.sequence(F.lit(1), last), lambda i: F.struct((i - 1).alias("at"), F.lit(LONG).alias("size"), F.xxhash64(F.slice("words", i, LONG)).alias("key")))
    parts = F.concat(F.transform("units", lambda u: F.struct(F.lit(0).alias("kind"), u["at"].alias("at"), u["size"].alias("size"), u["key"].alias("key"))), F.transform(F.when(last > 0, grams).otherwise(F.array().cast("array<struct<at:int,size:int,key:bigint>>")), lambda g: F.struct(F.lit(1).alias("kind"), g["at"].alias("at"), g["size"].alias("size"), g["key"].alias("key"))))
    runs = loose.select("page_id", "mark", "name", "host", "judged", "need", F.col("at").alias("from"), F.explode(parts).alias("g")).select("page_id", "mark", "name", "host", "judged", "need", "from", "g.*")
    repeated = runs.groupBy("host", "kind", "key").agg(F.count_distinct("name").alias("pages"), F.max("need").alias("need")).where("pages >= need").select("host", "kind", "key")
    salted = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = runs.where(F.exists(F.slice("judged", F.col("at") + 1, F.col("size")), lambda j: j)).withColumn("salt", F.pmod(F.xxhash64("mark", "from", "at"), F.lit(SALTS)).cast("int"))
    hit = own.join(salted, ["host", "kind", "key", "salt"], "left_semi")
    places = hit.select("page_id", "mark", "from", "judged", F.explode(F.sequence("at", F.col("at") + F.col("size") - 1)).alias("place")).where(F.element_at("judged", F.col("place") + 1))
    within = (F.col("place") + F.greatest(F.lit(0), F.col("from"))).cast("int")
    return places.groupBy("page_id", "mark", F.col("from").alias("at")).agg(F.collect_set(within).alias("positions"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", carry: list[str] | None = None, out: str = "main_text") -> DataFrame:
    """The columns ``carry`` of ``pages`` (default: all) and the main text in ``out``."""
    carry = pages.columns if carry is None else carry
    ident, mark, found_id, found_mark, outside, inside = C.free_name(pages, "page_key", "mark", "found_id", "found_mark", "outside", "inside")
    number = F.col(f"`{page_id}`").cast("long")
    keyed = pages.select(number.alias(ident), F.xxhash64(F.col(f"`{url}`"), F.col(f"`{html}`")).alias(mark), *[F.col(f"`{c}`") for c in dict.fromkeys([*carry, html])])
    name = F.xxhash64(number, F.col(f"`{url}`"))
    source = pages.select(number.alias("page_id"), F.xxhash64(F.col(f"`{url}`"), F.col(f"`{html}`")).alias("mark"), name.alias("name"), host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").alias("html"))
    every = C.checkpointed(_loose(source))
    loose = every.where(F.size("words") >= REPEAT).drop("article", "seeds").withColumns({"at": F.lit(-1), "need": F.lit(None).cast("long")})
    wanted = _host_seeds(every)
    if not C.is_empty(wanted):
        loose = loose.unionByName(C.checkpointed(_stretches(source, wanted)))
    pages_of = F.greatest(F.lit(2), F.ceil(F.lit(SHARE) * F.count_distinct("name"))).cast("long")
    sizes = loose.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.size("words")).alias("all_words"), F.coalesce(F.max("need"), pages_of).alias("need"), F.max(F.exists("judged", lambda j: j)).alias("asks"))
    sizes = C.checkpointed(sizes.where("asks"))
    small = (F.col("n") <= HOST_PAGES) & (F.col("all_words") <= HOST_WORDS)
    few, many = (loose.drop("need").join(sizes.where(s).select("host", "need"), "host") for s in (small, ~small))
    at = [F.flatten(F.collect_list(F.when(zone, F.col("positions")))) for zone in (F.col("at") < 0, F.col("at") >= 0)]
    marks = _by_host(few).unionByName(_by_count(many)).groupBy("page_id", "mark").agg(at[0].alias(outside), at[1].alias(inside))
    marks = C.checkpointed(marks.select(F.col("page_id").alias(found_id), F.col("mark").alias(found_mark), outside, inside))
    # Few pages have words to lose; more than can be broadcast safely are joined by a shuffle.
    sized = F.broadcast(marks) if marks.count() <= BROADCAST_PAGES else marks
    joined = keyed.join(sized, keyed[ident].eqNullSafe(marks[found_id]) & (keyed[mark] == marks[found_mark]), "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*carry, html])], outside, inside)
    names = joined.columns

    def run(batches):
        for batch in batches:
            column, gone = batch.column(names.index(html)), [batch.column(len(names) - k) for k in (2, 1)]
            for i, j in C.row_slices(C.text_bytes(column)[1]):
                texts = [main_text(x.as_py() or "", *(set(p.as_py() or ()) for p in places)) for x, *places in zip(column[i:j], *(g[i:j] for g in gone))]
                yield pa.RecordBatch.from_arrays([*[batch.column(names.index(c))[i:j] for c in carry], pa.array(texts, pa.string())], [*carry, out])

    return C.with_workers(joined).mapInArrow(run, T.StructType([*[pages.schema[c] for c in carry], T.StructField(out, T.StringType())]))


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    out = extract(pages.select("page_id", "url", "html"), carry=["page_id", "url"])
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
