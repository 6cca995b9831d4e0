"""Scalar functions of the reconciliation operators, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens of a boolean field, and words that name an inline secret.
TRUE_TOKENS = ["true", "yes", "1", "+"]
FALSE_TOKENS = ["false", "no", "0", "-"]
INLINE_SECRET = r"(?im)^\s*(?:password|passwd|token|api[_-]?key|secret)\s*:\s*['\"]?\S+"
FORMULA_START = "^[ \\t\\r\\n]*[=+\\-@]"
FEED_DATE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$"
SUPPLIER_ID = r"^[A-Za-z0-9][A-Za-z0-9_-]*$"
SHA256_HEX = "^[0-9a-f]{64}$"


def strip(x: Column) -> Column:
    """White space in the Unicode sense off both ends."""
    return F.regexp_replace(x, r"(?U)^\s+|(?U)\s+$", "")


def non_blank(x: Column) -> Column:
    """The stripped text, or null if nothing is left."""
    return F.nullif(strip(x), F.lit(""))


#: What an identity key is made of.
IDENTITY_CHARS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(chr(c) for c in range(ord("А"), ord("Я") + 1))


def identity_key(x: Column) -> Column:
    """Upper case with only digits and the letters A-Z and А-Я left; null becomes blank."""
    upper = F.upper(F.coalesce(x, F.lit("")))
    # What is left without these characters is what goes: a third of the time of a regular expression.
    return F.call_function("translate", upper, F.translate(upper, IDENTITY_CHARS, ""), F.lit(""))


def boolean_token(x: Column) -> Column:
    token = F.lower(strip(x))
    return F.when(token.isin(TRUE_TOKENS), True).when(token.isin(FALSE_TOKENS), False)


def strict_decimal(x: Column, kind: str = "decimal(20,4)") -> Column:
    """Null where the text is no finite number that fits as it is: none is rounded."""
    text = strip(x)
    value = text.try_cast(kind)
    return F.when(value == text.try_cast("decimal(38,18)"), value)


def quantity(x: Column, unknown: tuple[str, ...] = ("*", "**", "***")) -> Column:
    """A whole number; symbols for an unknown stock give null."""
    text = strip(x)
    return F.when(~text.isin(*unknown) & text.rlike("^-?[0-9]+$"), text.try_cast("int"))


def available(attribute: Column, stock: Column, symbol: Column, out_of_production: Column) -> Column:
    """Attribute, else stock above 0, else a stock symbol; never if out of production or at 0."""
    stated = F.coalesce(attribute, F.when(stock.isNotNull(), stock > 0), F.when(symbol, F.lit(True)))
    return F.when(F.coalesce(out_of_production, F.lit(False)) | (F.coalesce(stock, F.lit(1)) <= 0), False).otherwise(stated)


def one_or_conflict(values: Column) -> tuple[Column, Column]:
    """(the value if all are equal, is there a conflict) of a repeated element."""
    distinct = F.array_distinct(F.filter(values, lambda v: v.isNotNull()))
    return F.when(F.size(distinct) == 1, F.get(distinct, F.lit(0))), F.size(distinct) > 1


#: A tag of inner markup; a < that no name follows is text.
TAG = r"</?[A-Za-z_:][^<>]*>"


def element_text(x: Column) -> Column:
    """Text of an element that a parser has read: tags of inner markup off, stripped. References
    have been decoded by then and are not decoded again."""
    return strip(F.regexp_replace(x, TAG, ""))


def leading_text(x: Column) -> Column:
    """Text before the first inner tag, stripped."""
    return strip(F.regexp_replace(x, rf"(?s){TAG}.*$", ""))


def unwrapped(x: Column) -> Column:
    """Markup without comments, and with CDATA sections as text: their own marks are references then."""
    kept = F.regexp_replace(x, r"(?s)<!--.*?-->", "")
    cdata = F.regexp_extract_all(kept, F.lit(r"(?s)<!\[CDATA\[(.*?)\]\]>"), F.lit(1))

    def unwrap(text: Column, inner: Column) -> Column:
        escaped = F.replace(F.replace(F.replace(inner, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        return F.replace(text, F.concat(F.lit("<![CDATA["), inner, F.lit("]]>")), escaped)

    return F.aggregate(cdata, kept, unwrap)


def decoded(x: Column) -> Column:
    """Text with its character references decoded once."""

    def decode(text: Column, reference: Column) -> Column:
        hexadecimal = reference.rlike("^&#[xX]")
        digits = F.regexp_extract(reference, "([0-9A-Fa-f]+);", 1)
        code = F.lpad(F.when(hexadecimal, digits).otherwise(F.hex(digits.try_cast("long"))), 8, "0")
        return F.replace(text, reference, F.coalesce(F.decode(F.unhex(code), "UTF-32"), reference))

    def of(text: Column) -> Column:
        named = text
        for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'")):
            named = F.replace(named, F.lit(entity), F.lit(char))
        references = F.array_distinct(F.regexp_extract_all(named, F.lit("&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"), F.lit(0)))
        return F.when(F.contains(text, F.lit("&")), F.replace(F.aggregate(references, named, decode), F.lit("&amp;"), F.lit("&"))).otherwise(text)

    # The text is made once; most have no reference.
    return F.get(F.transform(F.array(x), of), F.lit(0))


def plain_text(x: Column) -> Column:
    """Text of raw markup: CDATA unwrapped, tags off, references decoded once, stripped."""
    return strip(decoded(F.regexp_replace(unwrapped(x), TAG, "")))


def category_key(x: Column) -> Column:
    """Category path as the text of a JSON array; text that is none is one part of a path."""
    return F.to_json(F.coalesce(F.when(F.trim(x).startswith("["), F.from_json(x, "array<string>")), F.array(x)))


def csv_safe(x: Column) -> Column:
    """A quote before text that a spreadsheet would take for a formula."""
    return F.when(x.rlike(FORMULA_START), F.concat(F.lit("'"), x)).otherwise(x)


def has_inline_secret(x: Column) -> Column:
    return x.rlike(INLINE_SECRET)


def url_allowed(url: Column, hosts: list[str], path: str = r"^/.*$") -> Column:
    """https, a listed host, no port but 443, no user, query or fragment, and a path that fits."""
    part = lambda name: F.try_parse_url(url, F.lit(name))
    port = F.regexp_extract(F.coalesce(part("AUTHORITY"), F.lit("")), r":(\d+)$", 1)
    fits = (F.lower(part("PROTOCOL")) == "https") & F.lower(part("HOST")).isin(hosts) & part("PATH").rlike(path) & port.isin("", "443")
    return F.coalesce(fits & part("USERINFO").isNull() & part("QUERY").isNull() & part("REF").isNull(), F.lit(False))


def valid_feed_date(x: Column) -> Column:
    return F.coalesce(x.rlike(FEED_DATE) & F.try_to_timestamp(x, F.lit("yyyy-MM-dd HH:mm")).isNotNull(), F.lit(False))


def snapshot_name(supplier: Column, feed_date: Column, sha256: Column) -> Column:
    stamp = F.date_format(F.try_to_timestamp(feed_date, F.lit("yyyy-MM-dd HH:mm")), "yyyyMMdd'T'HHmm")
    return F.concat_ws("-", supplier, F.lit("live"), stamp, F.substring(sha256, 1, 12))


def run_name(x: Column, sha256: Column) -> Column:
    safe = F.regexp_replace(F.regexp_replace(x, "[^A-Za-z0-9._-]+", "-"), "^[-.]+|[-.]+$", "")
    return F.concat_ws("-", F.coalesce(F.nullif(safe, F.lit("")), F.lit("run")), F.substring(sha256, 1, 12))


def safe_bundle_path(x: Column) -> Column:
    return ~x.rlike(r"^/|\\|(?:^|/)\.\.(?:/|$)|^$")


def dimensions(length: Column, width: Column, height: Column) -> Column:
    sides = [F.coalesce(c, F.lit("")) for c in (length, width, height)]
    return F.when(F.coalesce(length, width, height).isNotNull(), F.concat_ws(" x ", *sides))


def images(*lists: Column) -> Column:
    return F.filter(F.flatten(F.array(*lists)), lambda v: v.isNotNull() & (strip(v) != ""))


def canonical_json(columns: list[str]) -> Column:
    """Compact JSON of a row with its names in order."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})

