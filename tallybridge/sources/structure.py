"""What is really in a landed XML file: its structure, counted over splits that no task puts together.

Spark cuts a file at ``>`` and deals its splits to tasks.  A task reads its split from left to right and reduces
it to a summary: the closing tags that nothing in the split opens, the opening tags that nothing closes, and how
often each path occurs below the open ones - parallel bracket matching.  Summaries of neighbours compose, so a file's
are composed in order; there are as many as it has splits.

A split may begin inside a comment, a CDATA section, a processing instruction or a quoted attribute value that holds a ``>``.
Which, its task cannot know, so it reduces the split for each of these entries; they fall together as soon as the
construct would have ended.  The composition picks the entry that the split before leaves.

Files that fit into a split are read whole, as bytes, by the same reader.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.sources.bundle import hash_pieces
from tallybridge.sources.files import Files, list_files

#: Paths of more elements than this are not counted; a tag of more bytes is refused.
DEPTH, TAG_BYTES = 4, 1 << 20
#: Pieces that a split is read by while it has several ways to begin.
PIECES = 64
#: What ends each way in which a split can begin; text needs nothing.
ENTRIES = {"text": b"", "comment": b"-->", "cdata": b"]]>", "instruction": b"?>", "double": b'"', "single": b"'"}
_OPENERS = [(b"<!--", "comment"), (b"<![CDATA[", "cdata"), (b"<?", "instruction")]
_ATTRIBUTES = rb"""((?:[^<>"'/]+|"[^"]*"|'[^']*'|/(?!>))*+)"""
#: The commonest kinds come first; the second character tells them apart.  An element with nothing but text is one token.
_TOKEN = re.compile(
    rb"[^<]*(?:</([^\s<>/\"']+)\s*>|<([^\s<>/!?\"'=]+)" + _ATTRIBUTES + rb"(?:(/)>|>(?:[^<]*+(</\2\s*>))?)|<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|(<!(?!--|\[CDATA\[)(?:\"[^\"]*\"|'[^']*'|\[[^\]]*\]|[^<>\"'\[])*>))",
    re.S,
)
_CLOSED, _OPENED, _REST, _EMPTY, _LEAF, _DECLARED = range(1, 7)
_TAG_REST = re.compile(_ATTRIBUTES + rb"(/?)>", re.S)
_ANY = "*"


class Summary:
    """Of a run of markup: unmatched closing tags, unmatched opening tags, and how often each path was opened.

    A path is counted under (closed, names): so many of the tags that were open before the run had been closed, and
    these names were open since then.
    """

    __slots__ = ("closes", "opens", "counts", "broken", "declares", "root")

    def __init__(self):
        self.closes: list[str] = []
        self.opens: list[str] = []
        self.counts: dict[tuple[int, tuple[str, ...]], int] = {}
        self.broken = self.declares = False
        self.root: str | None = None

    def open(self, name: str, attributes: bytes) -> None:
        self.opens.append(name)
        if len(self.opens) <= DEPTH:
            key = (len(self.closes), tuple(self.opens))
            self.counts[key] = self.counts.get(key, 0) + 1
            if self.root is None and key == (0, (name,)):
                self.root = attributes.decode("utf-8", "replace")

    def close(self, name: str) -> None:
        if not self.opens:
            self.closes.append(name)
        elif (top := self.opens.pop()) != name and name != _ANY:
            self.broken = True
            del top

    def then(self, after: Summary) -> Summary:
        """This run and the one after it as one."""
        out = Summary()
        out.closes, out.opens, out.counts = list(self.closes), list(self.opens), dict(self.counts)
        out.broken, out.declares = self.broken or after.broken, self.declares or after.declares
        # The first tag of the run is a root only where nothing is open before it.
        out.root = self.root if self.root is not None or self.opens or self.closes else after.root
        for (closed, names), n in after.counts.items():
            path = (*self.opens[: max(0, len(self.opens) - closed)], *names)
            if len(path) <= DEPTH:
                key = (len(self.closes) + max(0, closed - len(self.opens)), path)
                out.counts[key] = out.counts.get(key, 0) + n
        for name in after.closes:
            out.close(name)
        out.opens += after.opens
        return out

    def packed(self) -> str:
        return json.dumps([self.closes, self.opens, [[k, list(p), n] for (k, p), n in self.counts.items()], self.broken, self.declares, self.root])

    @classmethod
    def unpacked(cls, text: str) -> Summary:
        out = cls()
        out.closes, out.opens, counts, out.broken, out.declares, out.root = json.loads(text)
        out.counts = {(k, tuple(p)): n for k, p, n in counts}
        return out


@functools.lru_cache(4096)
def _text(name: bytes) -> str:
    return name.decode("utf-8", "replace")


class Reader:
    """Reduces markup that comes in pieces, each of which ends with a ``>``, from one way to begin."""

    def __init__(self, entry: str):
        self.mode, self.rest, self.seen = entry, b"", Summary()

    def state(self) -> tuple[str, bytes]:
        return self.mode, self.rest

    def read(self, data: bytes) -> None:
        data, at, self.rest = self.rest + data, 0, b""
        while True:
            if self.mode != "text":
                end = data.find(ENTRIES[self.mode], at)
                if end < 0:
                    return
                at = end + len(ENTRIES[self.mode])
                if self.mode in ("double", "single"):
                    tag = _TAG_REST.match(data, at)
                    if tag is None:
                        # One more quoted value holds a > and goes on.
                        self.mode = self._quote(data[at:]) or "text"
                        self.seen.broken |= self.mode == "text"
                        return
                    if tag[2]:
                        self.seen.close(_ANY)
                    at = tag.end()
                self.mode = "text"
            at = data.find(b"<", self._tokens(data, at))
            if at < 0:
                return
            opener = next((m for mark, m in _OPENERS if data.startswith(mark, at)), None)
            if opener is None:
                self.rest = data[at:]
                if len(self.rest) > TAG_BYTES:
                    self.seen.broken, self.rest = True, b""
                return
            self.mode, at = opener, at + 2

    def _tokens(self, data: bytes, at: int) -> int:
        """Reads the tokens that adjoin from a place on; where they end."""
        seen, opens, match = self.seen, self.seen.opens, _TOKEN.match
        while (token := match(data, at)) is not None:
            at, kind = token.end(), token.lastindex
            if kind == _CLOSED:
                name = _text(token[_CLOSED])
                if opens and opens[-1] == name:
                    opens.pop()
                else:
                    seen.close(name)
            elif kind == _DECLARED:
                seen.declares = True
            elif kind is not None:
                if len(opens) < DEPTH:
                    seen.open(_text(token[_OPENED]), token[_REST])
                    if kind != _REST:
                        opens.pop()
                elif kind == _REST:
                    opens.append(_text(token[_OPENED]))
        return at

    @staticmethod
    def _quote(tag: bytes) -> str | None:
        left = re.sub(rb"\"[^\"]*\"|'[^']*'", b"", tag)
        found = re.search(rb"[\"']", left)
        return None if found is None else "double" if found[0] == b'"' else "single"

    def end(self) -> None:
        """At the end of a split a tag may be open inside a quoted value."""
        if self.rest:
            name = re.match(rb"<([^\s<>/!?\"'=]+)\s", self.rest)
            mode = self._quote(self.rest)
            if name is None or mode is None:
                self.seen.broken = True
            else:
                self.seen.open(name[1].decode("utf-8", "replace"), self.rest[name.end() :])
                self.mode = mode
            self.rest = b""


class Split:
    """The summaries of a split for every way to begin, of which the first of a file has one; those that have fallen together
    are read once."""

    def __init__(self, first: bool = False):
        entries = ["text"] if first else ENTRIES
        self.readers = {entry: Reader(entry) for entry in entries}
        #: What each entry had seen when it fell together with others, and with which reader it goes on.
        self.before = {entry: Summary() for entry in entries}
        self.follows = {entry: entry for entry in entries}
        self.n_bytes, self.blank_end = 0, False

    def read(self, data: bytes) -> None:
        for reader in self.readers.values():
            reader.read(data)
        if len(self.readers) == 1:
            return
        by_state: dict[tuple[str, bytes], list[str]] = {}
        for name, reader in self.readers.items():
            by_state.setdefault(reader.state(), []).append(name)
        for names in by_state.values():
            if len(names) > 1:
                for entry, of in self.follows.items():
                    if of in names:
                        self.before[entry] = self.before[entry].then(self.readers[of].seen)
                        self.follows[entry] = names[0]
                self.readers[names[0]].seen = Summary()
                for name in names[1:]:
                    del self.readers[name]

    def ends(self) -> Iterator[tuple[str, str, str]]:
        """(entry, exit, summary)."""
        for reader in self.readers.values():
            reader.end()
        for entry, of in self.follows.items():
            reader = self.readers[of]
            yield entry, reader.mode, self.before[entry].then(reader.seen).packed()


_SPLITS = "file string, size long, start long, n_bytes long, blank_end boolean, entry string, exit string, summary string"


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, split = None, None

    def told() -> pa.RecordBatch:
        rows = [(*now, split.n_bytes, split.blank_end, *end) for end in split.ends()]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[c.split()[0] for c in _SPLITS.split(", ")])

    for batch in batches:
        files, starts, chunks = batch.column(0), batch.column(2), batch.column(3)
        # Where another split begins: every row names its file, which is looked at only there.
        changes = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(starts[1:], starts[:-1]))
        ends = [*(np.flatnonzero(changes.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
        at = 0
        for end in ends:
            key = tuple(batch.column(i)[at].as_py() for i in range(3))
            if key != now:
                if split is not None:
                    yield told()
                now, split = key, Split(first=key[2] == 0)
            while at < end:
                # A little at a time, until the ways to begin have fallen together.
                n = end - at if len(split.readers) == 1 else min(end - at, PIECES)
                some = chunks.slice(at, n).to_pylist()
                data = b">".join(some) + b">"
                split.n_bytes += len(data)
                split.blank_end = not some[-1].strip()
                split.read(data)
                at += n
    if split is not None:
        yield told()


_FACTS = "file string, size long, n_splits int, root string, attributes string, roots long, declares boolean, broken boolean, counts map<string,long>"

_HASHED = f"{_FACTS}, sha256 string"


def _facts(whole: Summary, mode: str, cut_off: bool) -> tuple:
    """Of the columns of _FACTS those from the root on, of a whole file that was left in a mode."""
    counts = {"/".join(path): n for (closed, path), n in whole.counts.items() if closed == 0}
    roots = {p: n for p, n in counts.items() if "/" not in p}
    broken = whole.broken or cut_off or mode != "text" or bool(whole.closes or whole.opens) or sum(roots.values()) != 1
    return next(iter(roots), None), whole.root, sum(roots.values()), whole.declares, broken, counts


def _read_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files with their content to _FACTS and the hash of their bytes."""
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.map_(pa.string(), pa.int64()), pa.string()]
    names = [c.split()[0] for c in _HASHED.split(", ")]
    for batch in batches:
        rows = []
        for file, size, content in zip(*(batch.column(i) for i in range(3)), strict=True):
            data, reader, at = content.as_py(), Reader("text"), 0
            digest = hashlib.sha256(data).hexdigest()
            rest = data[data.rfind(b">") + 1 :]
            data += b">" if rest else b""
            while at < len(data):  # so that a tag that does not end is refused beyond TAG_BYTES
                end = data.find(b">", at + TAG_BYTES) + 1 or len(data)
                reader.read(data[at:end])
                at = end
            reader.end()
            rows.append((file.as_py(), size.as_py(), 1, *_facts(reader.seen, reader.mode, bool(rest.strip())), digest))
        yield pa.RecordBatch.from_arrays([pa.array([list(r[i].items()) if i == 8 else r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _composed(splits: pd.DataFrame) -> pd.DataFrame:
    """The splits of one file in order, each by the entry that the one before leaves."""
    whole, mode, n_bytes, blank_end = Summary(), "text", 0, True
    starts = sorted(set(splits["start"]))
    rows = {(s, e): (x, t, n, b) for s, e, x, t, n, b in zip(splits["start"], splits["entry"], splits["exit"], splits["summary"], splits["n_bytes"], splits["blank_end"], strict=True)}
    for start in starts:
        mode, summary, more, blank_end = rows[start, mode]
        whole = whole.then(Summary.unpacked(summary))
        n_bytes += more
    size = int(splits["size"].iloc[0])
    # A file that does not end with > has a last piece that was given one.
    cut_off = n_bytes > size and not blank_end
    root, attributes, roots, declares, broken, counts = _facts(whole, mode, cut_off)
    return pd.DataFrame({"file": [splits["file"].iloc[0]], "size": [size], "n_splits": [len(starts)], "root": [root], "attributes": [attributes], "roots": [roots], "declares": [declares], "broken": [broken], "counts": [counts]})


def file_structure(spark: SparkSession, path: str | list[str] | Files) -> DataFrame:
    """(file, size, n_splits, root, attributes, roots, declares, broken, counts, sha256) of every file under ``path``, or under each of a list.

    counts: how often each path of at most DEPTH names occurs (``shop/offers`` below the root ``r`` as ``r/shop/offers``);
    attributes: the text of the root's start tag; declares: is there a DOCTYPE or an entity declaration; broken: tags
    that do not match or are left open, text that is cut off, or not one root; sha256: of the bytes.  Files are read as bytes, so any encoding in which markup
    is ASCII will do; an empty file is broken.  A folder without files gives no rows.

    Files that are read whole (see ``Files``) are counted and hashed where they are read, in one scan and without a shuffle.
    """
    files = path if isinstance(path, Files) else list_files(spark, path)
    found = files.whole.mapInArrow(_read_whole, _HASHED)
    if files.large:
        meta = ["_metadata.file_path", "_metadata.file_size", "_metadata.file_block_start"]
        pieces = spark.read.option("lineSep", ">").text(files.large).select(*meta, F.col("value").cast("binary").alias("value"))
        split = pieces.mapInArrow(_reduced, _SPLITS).groupBy("file").applyInPandas(_composed, _FACTS)
        hashed = hash_pieces(spark.read.option("lineSep", "\n").text(files.large), F.col("_metadata.file_path"))
        found = found.unionByName(split.join(hashed.select(F.col("path").alias("file"), "sha256"), "file"))
    if files.empty:
        rows = [(f, 0, 0, None, None, 0, False, True, {}, hashlib.sha256(b"").hexdigest()) for f in files.empty]
        found = found.unionByName(spark.createDataFrame(rows, _HASHED))
    return found


def feed_facts(structure: DataFrame) -> DataFrame:
    """The facts of a feed that its gates ask for (see ``operators.gates``), counted in its file: ``file``, and root, shops,
    offer_lists, currency_lists, category_lists, currencies, items, bytes, head, feed_date, broken, sha256."""
    count = lambda *names: F.coalesce(F.element_at("counts", F.concat_ws("/", F.col("root"), *[F.lit(n) for n in names])), F.lit(0)).cast("long")
    date = F.regexp_extract("attributes", r"""(?:^|\s)date\s*=\s*(?:"([^"]*)"|'([^']*)')""", 1)
    other = F.regexp_extract("attributes", r"""(?:^|\s)date\s*=\s*(?:"([^"]*)"|'([^']*)')""", 2)
    return structure.select(
        "file",
        "root",
        count("shop").alias("shops"),
        count("shop", "offers").alias("offer_lists"),
        count("shop", "currencies").alias("currency_lists"),
        count("shop", "categories").alias("category_lists"),
        count("shop", "currencies", "currency").alias("currencies"),
        count("shop", "offers", "offer").alias("items"),
        F.col("size").alias("bytes"),
        F.when(F.col("declares"), "<!ENTITY").otherwise("").alias("head"),
        F.nullif(F.coalesce(F.nullif(date, F.lit("")), other), F.lit("")).alias("feed_date"),
        "broken",
        "sha256",
    )
