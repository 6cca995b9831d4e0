"""Elements of a fragment of XML as Column expressions: attributes, children, a hash of its canonical form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybridge.functions.text import TAG, decoded, strip, unwrapped

_NAME = r"[A-Za-z_][\w:.-]*+"
_ATTRIBUTES = rf"""((?:\s+{_NAME}\s*=\s*(?:"[^"<]*"|'[^'<]*'))*+)"""
ATTRIBUTE = rf"""({_NAME})\s*=\s*(?:"([^"]*)"|'([^']*)')"""
#: An element with its name, attributes and content; one inside another of its name is not told apart.
ELEMENT = rf"(?s)<({_NAME}){_ATTRIBUTES}\s*+(?:/>|>(.*?)</\1\s*>)"
WHOLE = rf"(?s)^\s*<({_NAME}){_ATTRIBUTES}\s*+(?:/>|>(.*)</\1\s*>)\s*$"
#: What no fragment may hold once CDATA and comments are gone: declarations, and references to entities of its own.
REFUSED_REFERENCE = r"&(?!(?:lt|gt|amp|quot|apos|#[0-9]+|#[xX][0-9A-Fa-f]+);)"
REFUSED = rf"<!|{REFUSED_REFERENCE}"


def attributes(x: Column) -> Column:
    """array<struct<name, value>> of the text of a start tag, in its order."""

    def of(text: Column) -> Column:
        group = lambda n: F.regexp_extract_all(text, F.lit(ATTRIBUTE), F.lit(n))
        pairs = F.arrays_zip(group(1).alias("name"), group(2).alias("a"), group(3).alias("b"))
        made = F.transform(pairs, lambda p: F.struct(p["name"].alias("name"), decoded(F.concat(p["a"], p["b"])).alias("value")))
        # Most children have none.
        return F.when(text == "", F.array().cast("array<struct<name:string,value:string>>")).otherwise(made)

    return F.get(F.transform(F.array(x), of), F.lit(0))


def parsed(fragment: Column) -> Column:
    """struct<name, attributes, children array<struct<name, attributes, text>>> of an element, children in document order.

    text is all that stands in a child, its inner tags off and its references decoded.  Null where the fragment is
    not one element, holds a declaration or an unknown reference, or has markup between its children that is
    none of them.
    """

    def of(plain: Column) -> Column:
        group = lambda n: F.regexp_extract_all(F.regexp_extract(plain, WHOLE, 3), F.lit(ELEMENT), F.lit(n))
        rows = F.arrays_zip(group(1).alias("name"), group(2).alias("a"), group(3).alias("x"))
        child = lambda c: F.struct(c["name"].alias("name"), attributes(c["a"]).alias("attributes"), strip(decoded(F.regexp_replace(c["x"], TAG, ""))).alias("text"))
        between = F.regexp_replace(F.regexp_extract(plain, WHOLE, 3), ELEMENT, "")
        whole = plain.rlike(WHOLE) & ~plain.rlike(REFUSED) & ~F.contains(between, F.lit("<"))
        made = F.struct(F.regexp_extract(plain, WHOLE, 1).alias("name"), attributes(F.regexp_extract(plain, WHOLE, 2)).alias("attributes"), F.transform(rows, child).alias("children"))
        return F.when(whole, made)

    # The fragment without comments and CDATA is made once.
    return F.get(F.transform(F.array(unwrapped(fragment)), of), F.lit(0))


def elements(fragment: Column) -> Column:
    """array<struct<key, value>> of an offer in document order: @attr of the offer, child tag, tag@attr, and param:<name>."""
    pair = lambda k, v: F.struct(k.alias("key"), v.alias("value"))

    def child(c: Column) -> Column:
        named = F.get(F.filter(c["attributes"], lambda a: a["name"] == "name"), F.lit(0))["value"]
        key = F.when(c["name"] == "param", F.concat(F.lit("param:"), F.coalesce(F.nullif(named, F.lit("")), F.lit("unnamed")))).otherwise(c["name"])
        more = F.when(c["name"] == "param", F.array().cast("array<struct<key:string,value:string>>")).otherwise(F.transform(c["attributes"], lambda a: pair(F.concat(c["name"], F.lit("@"), a["name"]), a["value"])))
        return F.concat(F.array(pair(key, c["text"])), more)

    def of(p: Column) -> Column:
        own = F.transform(p["attributes"], lambda a: pair(F.concat(F.lit("@"), a["name"]), a["value"]))
        return F.when(p.isNotNull(), F.concat(own, F.flatten(F.transform(p["children"], child))))

    return F.get(F.transform(F.array(parsed(fragment)), of), F.lit(0))


def row_hash(fragment: Column) -> Column:
    """SHA-256 of an element's canonical form: attributes by name, children in order, no comments, references and
    CDATA as the text they stand for.  So the order and the quotes of attributes do not matter; null if unparsable."""
    return parsed_hash(parsed(fragment))


def parsed_hash(element: Column) -> Column:
    """``row_hash`` of an element that ``parsed`` has read."""

    def of(p: Column) -> Column:
        children = F.transform(p["children"], lambda c: F.struct(c["name"].alias("name"), F.array_sort(c["attributes"]).alias("attributes"), c["text"].alias("text")))
        canonical = F.struct(p["name"].alias("name"), F.array_sort(p["attributes"]).alias("attributes"), children.alias("children"))
        return F.when(p.isNotNull(), F.sha2(F.to_json(canonical), 256))

    return F.get(F.transform(F.array(element), of), F.lit(0))
