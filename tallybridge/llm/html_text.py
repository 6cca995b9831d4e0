"""Main text of web pages by a site style tree (operator 1).

Pages of one host are merged into a style tree: an element node is a path of tags with their
class and id; its style nodes are the sequences of children it has on different pages; its
features are the text blocks right below it.  Importance is an entropy over the host's pages:

* presentation, NodeImp(E) = - sum p_i log_m p_i over the style nodes of E on m pages;
* content, 1 - mean of k / m over its blocks, for a block on k of m pages;
* composite, CompImp(E) = (1 - g^l) NodeImp(E) + g^l * mean of what is below (l style nodes, g = 0.9).

What m pages say weighs (m - 1) / m, so one page says nothing.  With LOW and REPEATED as they are, a branch that is the same on
all pages of its host goes from 10 pages on, a single block from 7.
The importance of a branch is the largest composite importance in it.  Times its prior - 0 for
what markup itself declares (menus, footers, adverts, comments ... and, on a page with an article,
what lies beside it), 1 for the rest - it must exceed LOW for the branch to stay; a single block
must not stand on nearly all pages of the host.  Inside an article two weak signs are asked for: a block goes for low
importance only where a word of the class, id or role around it hints at noise; text that merely repeats stays.

A class, id or role declares something by the word it is, or the head of its compound (site-footer, comment-body, commentlist;
not post-with-ads, related-work), and hints at it by any of its words; it does neither on html, body, main and article, nor where the
branch holds the page's only article or most of its text.  An article inside an article is a comment on it or a teaser,
unless the outer one has no text of its own; a header inside an article is the article's.  Pages of one host with the same
blocks are copies and count as one page.  The tree is summed in Spark by (host, node): composites go up it
by doubled steps, so no task holds a host.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.llm.common import bounded, cut, discard, stored

LOW, DAMPING = 0.1, 0.9
#: Share of the pages with its node, weighed, from which a single block counts as repeated.
REPEATED = 0.85
#: Distinct pages with low parts that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 20_000

#: Elements that are never main text, and words of class, id or role that say the same.
NOISE_TAGS = frozenset("nav header footer aside script style noscript template iframe button select option textarea svg canvas object embed dialog menu input head title math audio video map label".split())
SOFT_TAGS = frozenset("form fieldset".split())
NOISE_WORDS = frozenset(
    "nav navbar navigation menu menubar header masthead footer sidebar aside ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription social share sharing breadcrumb breadcrumbs comment comments disqus reply replies related recommended recommendations widget toolbar pagination pager login signup search skip copyright legal alert complementary contentinfo hidden adsbygoogle".split()
)
#: Words after which a compound has no other meaning, words that only modify a layout, and those
#: whose header belongs to the text.
QUALIFIERS = frozenset("area bar block body bottom box button buttons container content fixed group inner item items left link links list main outer panel post posts primary right secondary section slot thread top unit wrap wrapper".split())
MODIFIERS = frozenset("has with without no is not closed disabled enabled layout off on open opened".split())
TEXT_WORDS = frozenset("article entry post story".split())
#: Elements whose class, id or role declares nothing.
FRAME_TAGS = frozenset("html body main article".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe template xmp".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE_TAGS = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br nobr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES_SELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"""[>]|=\s*["']""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW_TAGS}
_MASK = (1 << 62) - 1
_ROOT = 1


def _noisy(word: str) -> bool:
    """Is it a word of noise, or one run together with a qualifier (commentlist)?"""
    return word in NOISE_WORDS or any(word.endswith(q) and word[: -len(q)] in NOISE_WORDS for q in QUALIFIERS if len(q) > 3)


def declares(name: str) -> bool:
    """Does a class, id or role say that its element is no main text?"""
    said = [w.lower() for w in _WORDS.findall(name)]
    if not MODIFIERS.isdisjoint(said):
        return False
    while len(said) > 1 and said[-1] in QUALIFIERS:
        said.pop()
    return bool(said) and _noisy(said[-1]) and not (said[-1] == "header" and len(said) > 1 and said[-2] in TEXT_WORDS)


def hints(name: str) -> bool:
    """Does any word of a class, id or role speak of noise?"""
    said = [w.lower() for w in _WORDS.findall(name)]
    return MODIFIERS.isdisjoint(said) and TEXT_WORDS.isdisjoint(said) and any(map(_noisy, said))


def _signature(tag: str, attrs: str, memo: dict = {}) -> tuple[int, bool, bool, bool]:  # noqa: B006
    """Number of a tag with its class and id, whether it is no main text, whether a form or
    a word of its class, id or role says so, and whether one hints at it."""
    key = (tag, attrs)
    found = memo.get(key)
    if found is None:
        named = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if "=" in attrs else {}
        said = " ".join(named.get(k, "") for k in ("class", "id", "role"))
        soft = tag in SOFT_TAGS or tag not in FRAME_TAGS and any(map(declares, said.split()))
        noise = tag in NOISE_TAGS
        noise |= named.get("aria-hidden") == "true" or "display:none" in named.get("style", "").replace(" ", "") or re.search(r"(?:^|\s)hidden(?:$|[\s=])", attrs) is not None
        shown = re.sub(r"\d+", "0", f"{tag} {named.get('class', '')} {named.get('id', '')}")
        found = crc32(shown.encode()), noise, soft, tag not in FRAME_TAGS and any(map(hints, said.split()))
        if len(memo) < 50_000 and len(attrs) < 1000:
            memo[key] = found
    return found


def _text_id(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") & _MASK


class _Frame:
    """An open element."""

    __slots__ = ("tag", "node", "noise", "inside", "article", "soft", "hinted", "last", "style")

    def __init__(self, tag, node, noise, inside, article, soft, hinted):
        self.tag, self.node, self.noise, self.inside, self.article, self.soft, self.hinted = tag, node, noise, inside, article, soft, hinted
        self.last, self.style = 0, 0  # the child before, and the sequence of children so far


class Page:
    """The text blocks of a page, and what it adds to the style tree of its host.

    Every step looks at the end of some stack, so a page costs its length, however deep or broken.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[int, str, bool, bool, bool]] = []  # node, text, noise, in an article or main element, in an article and not hinted at
        self.nodes: dict[int, tuple[int, int]] = {}  # node -> parent, depth
        self.styles: set[tuple[int, int]] = set()
        self._open = [_Frame("#root", _ROOT, False, False, False, 0, False)]
        self._solid = [0]  # places of the open elements that are not inline
        self._at: dict[str, list[int]] = {}  # places of the open elements of each tag
        self._text: list[str] = []
        self._nested: set[int] = set()  # branches that are articles inside an article
        self._softs = [0]  # of each branch that a word declares as noise, the one around it
        self._soft_of: list[int] = []  # of each block, the innermost such branch
        self._parse(source)

    def _flush(self) -> None:
        if self._text:
            text = " ".join(html.unescape("".join(self._text)).split())
            self._text = []
            if text:
                own = self._open[self._solid[-1]]
                self.blocks.append((own.node, text, own.noise, own.inside, own.article and not own.hinted))
                self._soft_of.append(own.soft)

    def _close(self, upto: int) -> None:
        while len(self._open) > upto:
            frame = self._open.pop()
            self._at[frame.tag].pop()
            if self._solid[-1] == len(self._open):
                self._solid.pop()
                self.styles.add((frame.node, frame.style))

    def _place(self, tags: tuple) -> int:
        return max((at[-1] for t in tags if (at := self._at.get(t))), default=0)

    def _push(self, tag: str, frame: _Frame) -> None:
        self._at.setdefault(tag, []).append(len(self._open))
        self._open.append(frame)

    def _start(self, tag: str, attrs: str) -> None:
        inline = tag in INLINE_TAGS
        if not inline:
            self._flush()
            if tag in CLOSES_P:
                self._end_of(("p",), ("button", "table", "td", "th"))
            elif tag in CLOSES_SELF:
                self._end_of(CLOSES_SELF[tag], ("ul", "ol", "dl", "table", "select"))
        if tag == "br":
            self._text.append(" ")
        if tag in VOID_TAGS:
            return
        sign, noise, soft, hinted = _signature(tag, attrs)
        above = self._open[-1]
        if above.article:
            soft |= tag == "article"
            if tag == "header":  # hidden ones are found by their attributes
                noise = _signature("section", attrs)[1]
        around = above.soft
        if soft:
            self._softs.append(around)
            around = len(self._softs) - 1
            if above.article and tag == "article":
                self._nested.add(around)
        if inline:
            self._push(tag, _Frame(tag, above.node, above.noise or noise or soft, above.inside, above.article, above.soft, above.hinted))
            return
        solid = self._open[self._solid[-1]]
        node = (solid.node * 0x5851F42D4C957F2D + sign) & _MASK
        if sign != solid.last:  # a run of equal children is one
            solid.style = (solid.style * 0x2545F4914F6CDD1D + sign) & _MASK
            solid.last = sign
        noise = noise or above.noise
        self.nodes.setdefault(node, (solid.node, len(self._solid)))
        self._solid.append(len(self._open))
        self._push(tag, _Frame(tag, node, noise, above.inside or (tag in ("article", "main") and not noise), above.article or (tag == "article" and not noise), around, above.hinted or hinted))

    def _end_of(self, tags: tuple, stop: tuple) -> None:
        at = self._place(tags)
        if at and at > self._place(stop):
            self._close(at)

    def _end(self, tag: str) -> None:
        if tag not in INLINE_TAGS:
            self._flush()
        at = self._place((tag,))
        if at and (tag not in INLINE_TAGS or at > self._solid[-1]):
            self._close(at)

    def _say(self, text: str) -> None:
        # What an inline element hides is not part of the block around it.
        if not self._open[-1].noise or self._open[self._solid[-1]].noise:
            self._text.append(text)

    def _parse(self, source: str) -> None:
        at, last_end = 0, source.rfind(">")
        unclosed: set[str] = set()
        while 0 <= (open_ := source.find("<", at)) < last_end:
            if open_ > at:
                self._say(source[at:open_])
            if source.startswith("<!--", open_):
                end = source.find("-->", open_ + 4)
                at = end + 3 if end >= 0 else len(source)
                continue
            close = source.startswith("/", open_ + 1)
            name = _NAME.match(source, open_ + 1 + close)
            if name is None:
                if source[open_ + 1] in "!?/":
                    at = source.index(">", open_) + 1
                else:
                    self._say("<")
                    at = open_ + 1
                continue
            tag = name[0].lower()
            end = self._tag_end(source, name.end(), unclosed)
            attrs, at = source[name.end() : end], end + 1
            if close:
                self._end(tag)
            elif tag in RAW_TAGS:
                self._flush()
                found = _RAW_END[tag].search(source, at)
                at = found.end() if found else len(source)
            else:
                self._start(tag, attrs)
                if attrs.endswith("/") and tag in ("svg", "math"):
                    self._end(tag)
        comment = source.find("<!--", at)
        self._say(source[at:] if comment < 0 else source[at:comment])
        self._flush()
        self._close(1)
        self.styles.add((_ROOT, self._open[0].style))
        if len(self._softs) > 1:
            self._judge()

    @staticmethod
    def _tag_end(source: str, at: int, unclosed: set[str]) -> int:
        """Place of the > that ends a tag: one outside of quoted values, or else the next."""
        first = at
        while (m := _STOP.search(source, at)) is not None:
            if m[0] == ">":
                return m.start()
            at, quote = m.end(), m[0][-1]
            if quote not in unclosed:
                end = source.find(quote, at)
                if end < 0:
                    unclosed.add(quote)
                else:
                    at = end + 1
        return source.index(">", first)

    def _judge(self) -> None:
        """Branches that a word declares as noise are, unless one holds all article text of the page
        or, where no article or main element has any, most of the page's distinct text."""
        shown = [i for i, b in enumerate(self.blocks) if not b[2]]
        articles = [i for i in shown if self.blocks[i][3]]
        held, size = [0] * len(self._softs), 0
        if not any(not self._soft_of[i] for i in articles):
            for i in {self.blocks[i][1]: i for i in (articles or shown)}.values():
                size += len(self.blocks[i][1])
                held[self._soft_of[i]] += len(self.blocks[i][1])
        lost = [False] * len(self._softs)
        for s in range(len(held) - 1, 0, -1):
            held[self._softs[s]] += held[s]
        for s in range(1, len(held)):
            lost[s] = lost[self._softs[s]] or 2 * held[s] <= size and not (size and s in self._nested)
        self.blocks = [(node, text, noise or lost[s], inside, article) for (node, text, noise, inside, article), s in zip(self.blocks, self._soft_of, strict=True)]

    def kept(self) -> list[tuple[int, str, bool]]:
        """(node, text, lasting) of the blocks that their prior lets stay."""
        article = any(b[3] and not b[2] for b in self.blocks)
        return [(node, text, lasting) for node, text, noise, inside, lasting in self.blocks if not noise and (inside or not article)]

    def main_text(self, low: frozenset = frozenset()) -> str:
        """low: nodes, and blocks as node xor block number, that the tree tells to remove."""
        return "\n".join(text for node, text, lasting in self.kept() if lasting or not low or not (node in low or (node ^ _text_id(text)) in low))

    def digest(self) -> bytes:
        return blake2b("\n".join(f"{n} {text}" for n, text, *_ in self.blocks).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


_SEEN = "host string, node long, kind int, value long, depth int, n long"
_PART = np.dtype([("node", "<i8"), ("kind", "<i4"), ("value", "<i8"), ("depth", "<i4")])


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page: its host, a digest of its blocks, and what it adds to the tree as packed parts.

    Kind 0: it has the node (value: its parent); 1: a style node; 2: a block; 3: a block that its
    prior lets stay and that may go (value: as it is told to be low).
    """
    for batch in batches:
        hosts, digests, packed = [], [], []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            page = Page(source)
            found = {(n, 0, parent, depth) for n, (parent, depth) in page.nodes.items()} | {(_ROOT, 0, 0, 0)}
            found |= {(n, 1, style, 0) for n, style in page.styles}
            found |= {(n, 2, _text_id(text), 0) for n, text, *_ in page.blocks}
            found |= {(n, 3, n ^ _text_id(text), 0) for n, text, lasting in page.kept() if not lasting}
            hosts.append(host)
            digests.append(page.digest())
            packed.append(np.array(sorted(found), _PART).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(digests, pa.binary()), pa.array(packed, pa.binary())], names=["host", "digest", "parts"])


def _unpacked(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Parts of several pages, and the page of each."""
    return np.frombuffer(b"".join(packed), _PART), np.repeat(np.arange(len(packed)), [len(x) // _PART.itemsize for x in packed])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of each part, within a batch."""
    for batch in batches:
        parts, of = _unpacked(batch.column(1).to_pylist())
        parts, of = parts[parts["kind"] < 3], of[parts["kind"] < 3]
        rows = pa.table({"host": batch.column(0).take(pa.array(of))} | {k: np.ascontiguousarray(parts[k]) for k in _PART.names})
        counted = rows.group_by(["host", *_PART.names], use_threads=False).aggregate([([], "count_all")])
        yield from counted.rename_columns([*counted.column_names[:-1], "n"] if counted.column_names[-1] == "count_all" else ["n", *counted.column_names[1:]]).select(["host", *_PART.names, "n"]).to_batches()


def _removable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, digest, part) of the blocks that may go: their node, and the block itself."""
    for batch in batches:
        parts, of = _unpacked(batch.column(2).to_pylist())
        use = np.flatnonzero(parts["kind"] == 3)
        if len(use):
            pages = pa.array(np.repeat(of[use], 2))
            which = np.stack([parts["node"][use], parts["value"][use]], 1).ravel()
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pages), batch.column(1).take(pages), pa.array(which)], names=["host", "digest", "part"])


def weighed(importance, m):
    """Importance by the evidence of m pages: 1 for one page, itself for very many."""
    return 1 - (1 - importance) * (m - 1) / m


def _double(step: DataFrame) -> DataFrame:
    """Twice as far up: every node hands its sum to the node it points at and takes over its way."""
    given = step.where("jump <> 0").groupBy("host", F.col("jump").alias("node")).agg(F.sum(F.col("product") * F.col("sum")).alias("given"))
    way = step.where("jump <> 0").select("host", F.col("node").alias("jump"), F.col("jump").alias("further"), F.col("product").alias("times"))
    both = step.join(given, ["host", "node"], "left").join(way, ["host", "jump"], "left")
    return both.select("host", "node", "parent", F.coalesce("further", F.lit(0)).alias("jump"), "depth", "m", "content", (F.col("sum") + F.coalesce("given", F.lit(0.0))).alias("sum"), (F.col("product") * F.coalesce("times", F.lit(0.0))).alias("product"))


def _double_most(step: DataFrame) -> DataFrame:
    given = step.where("jump <> 0").groupBy("host", F.col("jump").alias("node")).agg(F.max("most").alias("given"))
    way = step.where("jump <> 0").select("host", F.col("node").alias("jump"), F.col("jump").alias("further"))
    both = step.join(given, ["host", "node"], "left").join(way, ["host", "jump"], "left")
    return both.select("host", "node", "parent", F.coalesce("further", F.lit(0)).alias("jump"), "depth", F.greatest("most", F.coalesce("given", F.lit(0.0))).alias("most"))


def importance(seen: DataFrame) -> DataFrame:
    """(host, node, importance): of each node the largest composite importance in its branch.

    seen: (host, node, kind, value, depth, n), as pages tell it.  With k the weight of a node in the
    mean of its parent, CompImp(E) is the sum over the nodes D below of their own term times the product
    of k from D up to E.  Sums and products go up by 1, 2, 4 ... steps at once.
    """
    nodes = seen.where("kind = 0").groupBy("host", "node").agg(F.first("value").alias("parent"), F.max("depth").alias("depth"), F.sum("n").alias("m"))
    share = F.col("n") / F.col("all")
    styles = seen.where("kind = 1")
    total = styles.groupBy("host", "node").agg(F.sum("n").alias("all"), F.count("*").alias("n_styles"))
    presentation = styles.join(total, ["host", "node"]).groupBy("host", "node", "n_styles", "all").agg((-F.sum(share * F.log(share))).alias("entropy"))
    # The mean of n / m over a node's blocks needs m once: blocks are summed before they meet it.
    texts = seen.where("kind = 2").groupBy("host", "node").agg(F.avg("n").alias("mean_n"))
    below = nodes.groupBy("host", F.col("parent").alias("node")).agg(F.sum("m").alias("m_below"))
    joined = nodes.join(presentation, ["host", "node"], "left").join(texts, ["host", "node"], "left").withColumn("content", 1 - F.col("mean_n") / F.col("m")).join(below, ["host", "node"], "left")
    # A node may have several style nodes on one page: the logarithm is to the base of all of them.
    own = joined.select(
        "host", "node", "parent", "depth", "m",
        F.when(F.col("all") > 1, F.col("entropy") / F.log("all")).otherwise(0.0).alias("presentation"),
        F.pow(F.lit(DAMPING), F.greatest(F.lit(1), F.coalesce("n_styles", F.lit(1)))).alias("keep"),
        "content",
        (F.coalesce("m_below", F.lit(0)) + F.when(F.col("content").isNotNull(), F.col("m")).otherwise(0)).alias("weight"),
    )
    below_all = F.nullif("weight", F.lit(0))
    inner = F.col("keep") * F.coalesce("content", F.lit(0.0)) * F.col("m") / below_all
    terms = own.select("host", "node", "parent", "depth", "m", F.when(F.col("weight") == 0, F.col("presentation")).otherwise((1 - F.col("keep")) * F.col("presentation") + inner).alias("own"), (F.col("keep") / below_all).alias("per_page"), "content")
    up = terms.select("host", F.col("node").alias("parent"), F.col("per_page").alias("above"))
    step = cut(terms.join(up, ["host", "parent"], "left").select("host", "node", "parent", F.col("parent").alias("jump"), "depth", "m", "content", F.col("own").alias("sum"), (F.col("m") * F.col("above")).alias("product")))
    rounds = int(np.ceil(np.log2((step.agg(F.max("depth")).first()[0] or 0) + 1)))
    for _ in range(rounds):
        step = cut(_double(step))
    # Many style nodes, or many low branches, do not hide one that matters.
    most = cut(step.select("host", "node", "parent", F.col("parent").alias("jump"), "depth", F.greatest(weighed(F.col("sum"), F.col("m")), weighed(F.coalesce("content", F.lit(0.0)), F.col("m"))).alias("most")))
    for _ in range(rounds):
        most = cut(_double_most(most))
    return most.select("host", "node", F.col("most").alias("importance"))


def low_parts(seen: DataFrame, low: float = LOW) -> DataFrame:
    """(host, part): nodes, and blocks as node xor block number, of low importance on their host."""
    branches = importance(seen).where(F.col("importance") <= low).select("host", F.col("node").alias("part"))
    pages_with = seen.where("kind = 0").groupBy("host", "node").agg(F.sum("n").alias("m"))
    blocks = seen.where("kind = 2 and n > 1").join(pages_with, ["host", "node"])
    repeated = blocks.where(weighed(1 - F.col("n") / F.col("m"), F.col("m")) <= 1 - REPEATED).select("host", F.expr("node ^ value").alias("part"))
    return branches.union(repeated)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", low: float = LOW, tree: bool = True) -> DataFrame:
    """(id, url, text, n_chars) of every row: the main text, a line for each block.

    Character references are decoded, white space inside a block becomes one space.  A null or
    empty page has an empty text; a null url, or one without a host, gives and gets no evidence
    of a site; rows that repeat are extracted each (and count as one page of their site); other
    columns are ignored; an empty table gives an empty result.  Without ``tree`` the priors act alone.
    """
    types = dict(pages.dtypes)
    rows = bounded(pages).select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{url_col}`").alias("__url"), F.col(f"`{html_col}`").alias("__html")).withColumn("__host", _host(F.col("__url")))
    names, kinds = [id_col, url_col, "text", "n_chars"], f"`{id_col}` {types[id_col]}, `{url_col}` {types[url_col]}, text string, n_chars long"

    def finished(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names)

    def plainly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield finished(batch, [Page(x).main_text() if x else "" for x in batch.column(2).to_pylist()])

    plain = rows.select("__id", "__url", "__html")
    if not tree:
        return plain.mapInArrow(plainly, kinds)
    known = rows.where("__host <> '' and __html is not null").select(F.col("__host").alias("host"), F.col("__html").alias("html"))
    once = stored(known.mapInArrow(_observe, "host string, digest binary, parts binary").groupBy("host", "digest").agg(F.min("parts").alias("parts")), "pages-once")
    seen = stored(once.select("host", "parts").mapInArrow(_count, _SEEN).groupBy("host", "node", "kind", "value", "depth").agg(F.sum("n").alias("n")), "style-tree")
    may_go = once.mapInArrow(_removable, "host string, digest binary, part long").join(low_parts(seen, low), ["host", "part"])
    flagged = stored(may_go.groupBy("host", "digest").agg(F.collect_set("part").alias("low")), "low-parts")
    discard(once, seen)

    n_flagged = flagged.count()
    if not n_flagged:
        return plain.mapInArrow(plainly, kinds)
    parsed = rows.mapInArrow(_parsed, f"__id {types[id_col]}, __url {types[url_col]}, __host string, digest binary, blocks array<struct<node:long,whole:long,text:string,lasting:boolean>>")
    told = flagged.select(F.col("host").alias("__host"), "digest", "low")
    joined = parsed.join(F.broadcast(told) if n_flagged <= BROADCAST_ROWS else told, ["__host", "digest"], "left")
    stays = lambda b: b["lasting"] | F.col("low").isNull() | ~(F.array_contains("low", b["node"]) | F.array_contains("low", b["whole"]))
    text = F.array_join(F.transform(F.filter("blocks", stays), lambda b: b["text"]), "\n")
    return joined.select(F.col("__id").alias(id_col), F.col("__url").alias(url_col), text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, url, host, digest, blocks) of the pages: what their priors let stay."""
    kind = pa.list_(pa.struct([("node", pa.int64()), ("whole", pa.int64()), ("text", pa.string()), ("lasting", pa.bool_())]))
    for batch in batches:
        pages = [Page(x or "") for x in batch.column(2).to_pylist()]
        blocks = [[{"node": n, "whole": n ^ _text_id(text), "text": text, "lasting": lasting} for n, text, lasting in p.kept()] for p in pages]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array([p.digest() for p in pages], pa.binary()), pa.array(blocks, kind)], names=["__id", "__url", "__host", "digest", "blocks"])
