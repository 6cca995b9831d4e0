"""The canonical form of an element and its hash, read in tasks: what ``markup.row_hash`` gives."""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tallybridge.functions import markup
from tallybridge.functions.text import TAG

# As in Java's expressions, \w and \s are those of ASCII.
_WHOLE, _ATTRIBUTE = re.compile(markup.WHOLE, re.A), re.compile(markup.ATTRIBUTE, re.A)
#: ``markup.ELEMENT``, which goes through its text from one < to the next.
_ELEMENT = re.compile(markup.ELEMENT.replace("(.*?)", r"([^<]*+(?:<(?!/\1\s*>)[^<]*+)*+)"), re.A)
_REFUSED = re.compile(markup.REFUSED_REFERENCE)
_TAG, _COMMENT, _CDATA = re.compile(TAG), re.compile("(?s)<!--.*?-->"), re.compile(r"(?s)<!\[CDATA\[(.*?)\]\]>")
_REFERENCE, _CONTROL = re.compile("&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"), re.compile(r"\\\\|\\u00[0-9a-f]{2}")
#: White space in the Unicode sense.
_BLANK = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_quoted = json.encoder.encode_basestring
_NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"))


def _decoded(text: str) -> str:
    if "&" not in text:
        return text
    for entity, char in _NAMED:
        text = text.replace(entity, char)
    for reference in dict.fromkeys(_REFERENCE.findall(text)):
        code = int(reference[3:-1], 16) if reference[2] in "xX" else int(reference[2:-1])
        if code < 0xD800 or 0xDFFF < code < 0x110000:
            text = text.replace(reference, chr(code))
    return text.replace("&amp;", "&")


def _attributes(text: str) -> list[tuple[str, str]]:
    return [(name, _decoded(a or b)) for name, a, b in _ATTRIBUTE.findall(text)] if text else []


def _json(text: str) -> str:
    quoted = _quoted(text)
    if "\\" not in quoted:
        return quoted
    # Spark writes the digits of a control character large.
    return _CONTROL.sub(lambda m: m[0][:2] + m[0][2:].upper(), quoted) if "\\u00" in quoted else quoted


def _sorted(pairs: list[tuple[str, str]]) -> str:
    return ",".join(f'{{"name":{_json(n)},"value":{_json(v)}}}' for n, v in sorted(pairs))


@functools.lru_cache(4096)
def _start(name: str, attributes: str) -> str:
    """Of a child what comes before its text."""
    return f'{{"name":{_json(name)},"attributes":[{_sorted(_attributes(attributes))}],"text":'


def canonical(fragment: str | None) -> tuple[list[tuple[str, str]], str] | None:
    """(attributes in their order, canonical JSON); None where ``markup.parsed`` gives null."""
    if fragment is None:
        return None
    plain = _COMMENT.sub("", fragment) if "<!--" in fragment else fragment
    if "<![CDATA[" in plain:
        for inner in _CDATA.findall(plain):
            plain = plain.replace(f"<![CDATA[{inner}]]>", inner.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;"))
    whole = _WHOLE.search(plain)
    if whole is None or "<!" in plain or ("&" in plain and _REFUSED.search(plain)):
        return None
    body = whole[3] or ""
    found = _ELEMENT.findall(body)
    texts = [text for _, _, text in found]
    # Nothing but children has a <, if each of them has two and those of its text.
    plain_children = all(texts) and body.count("<") == 2 * len(found) + sum(text.count("<") for text in texts if "<" in text)
    if not plain_children and "<" in _ELEMENT.sub("", body):
        return None
    texts = [_decoded(_TAG.sub("", text) if "<" in text else text) if "&" in text or "<" in text else text for text in texts]
    children = [f"{_start(name, own)}{_json(text.strip(_BLANK))}}}" for (name, own, _), text in zip(found, texts, strict=True)]
    attributes = _attributes(whole[2])
    return attributes, f'{{"name":{_json(whole[1])},"attributes":[{_sorted(attributes)}],"children":[{",".join(children)}]}}'


def _told(fragments: Iterable[str | None]) -> list[pa.Array]:
    """Ids and hashes."""
    ids, hashes = [], []
    for fragment in fragments:
        found = canonical(fragment)
        ids.append(None if found is None else next((v for n, v in found[0] if n == "id"), None))
        hashes.append(None if found is None else hashlib.sha256(found[1].encode()).hexdigest())
    return [pa.array(ids, pa.string()), pa.array(hashes, pa.string())]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        told = _told(batch.column(2).to_pylist())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *told], names=[*batch.schema.names[:2], "id", "row_hash"])


def hashed(placed: DataFrame) -> DataFrame:
    """(key, position, id, row_hash) of elements (key, position, fragment): their attribute ``id`` and what ``markup.row_hash`` gives."""
    (key, kind), *_ = placed.dtypes
    return placed.mapInArrow(_hashed, f"`{key}` {kind}, position long, id string, row_hash string")


def hashed_in_files(files: DataFrame, tag: str = "offer") -> DataFrame:
    """The same of the elements of a tag in whole files (key, content), cut and numbered as ``feeds.read_placed`` does."""
    closing, start = f"</{tag}>", re.compile(rf"<{tag}\b", re.A)
    (key, kind), *_ = files.dtypes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, content in enumerate(batch.column(1)):
                pieces = content.as_py().decode("utf-8", "replace").split(closing)
                found = [(at, piece[m.start() :] + closing) for at, piece in enumerate(pieces, 1) if (m := start.search(piece))]
                keys = batch.column(0).take(pa.array([i] * len(found), pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, pa.array([at for at, _ in found], pa.int64()), *_told(x for _, x in found)], names=[key, "position", "id", "row_hash"])

    return files.mapInArrow(run, f"`{key}` {kind}, position long, id string, row_hash string")
