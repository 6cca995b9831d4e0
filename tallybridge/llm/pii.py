"""Personal data by candidate gradient boosting (operator 11).

Built of DataFrame and SQL functions only.  Four base patterns with their checks find what is certain.
Generators of high recall propose further spans, which overlap each other and the base ones: addresses in words or in
other letters, numbers in other groupings, other kinds.  Boosted trees, written out as CASE expressions, score a candidate by its
format and its context; a threshold of its kind, set on labelled texts that the trees have not seen, decides.  Of
added spans that overlap the best stays, and none that overlaps a base span.

Every pattern goes through a text twice, for its matches and for what lies between them; places are running sums of
their lengths, and contexts are taken from what lies between, so the work is in proportion to the text however many matches
there are.  Nothing is shuffled and the corpus is read once.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.llm import labelled_pii
from tallybridge.llm.folds import let, scan
from tallybridge.llm.secrets import _tree

#: Kinds in their order; the first four have a base pattern (fixed values).
KINDS = ["email", "ip", "card", "phone", "iban", "id"]
#: The base patterns of the contract. Runs are possessive where giving back cannot help, which keeps them linear, and an
#: address starts where a run of its characters does or the match before it ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_AT = r"(?:\x20?[(\[{<]\x20?(?:at|@)\x20?[)\]}>]\x20?|\x20at\x20|\x20?@\x20?)"
_DOT = r"(?:\x20?[(\[{<]\x20?(?:dot|\.)\x20?[)\]}>]\x20?|\x20dot\x20|\.)"
#: (kind, pattern) of the generators.
GENERATORS = [
    ("email", rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++"),
    ("email", r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++@[\p{L}0-9-]++(?:\.[\p{L}0-9-]++)++"),
    ("ip", r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}+(?![0-9A-Za-z:])"),
    ("ip", r"(?i)(?<![0-9A-Za-z])[0-9]{1,3}(?:(?:\x20?[(\[](?:dot|\.)[)\]]\x20?|\x20dot\x20)[0-9]{1,3}){3}+(?![0-9A-Za-z])"),
    ("card", r"(?<![A-Za-z0-9])(?<![0-9][\x20./-])[0-9](?:[\x20./-]{0,2}+[0-9]){11,18}+(?![\x20./-]{0,2}[A-Za-z0-9])"),
    ("card", r"(?<![A-Za-z0-9])[0-9]{12,19}+(?![A-Za-z0-9])"),
    ("phone", r"(?<![A-Za-z0-9+])(?:00|\+|\()?[0-9](?:[\x20()./-]{0,2}+[0-9]){6,14}+(?![0-9A-Za-z])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]){11,30}+(?![A-Za-z0-9])"),
    ("id", r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])"),
]
#: Words of fixed meaning, in natural order.
OWN_WORDS = {
    "email": r"\b(?:address|contact|e-?mail|mail|write)\b",
    "ip": r"\b(?:address|connect\w*|from|host|ip|login|logged|server|user)\b",
    "card": r"\b(?:amex|card|charge|credit|debit|mastercard|visa)\b",
    "phone": r"\b(?:call|fax|mobile|phone|reach|tel|telephone|whatsapp)\b",
    "iban": r"\b(?:account|bank|bic|iban|transfer)\b",
    "id": r"\b(?:passport|security|social|ssn|tax|taxpayer)\b",
}
BENIGN_WORDS = r"\b(?:build|chapter|code|date|duration|invoice|isbn|issn|order|page|pages|part|price|ref|release|serial|sku|table|timestamp|tracking|version|year)\b"
ENDINGS = r"(?:com|org|net|edu|gov|info|io|de|fr|es|it|nl|uk|eu|ch|at|us)"
CONTEXT = 40

FEATURES = [*(f"is_{k}" for k in KINDS), "length", "digits", "letters", "others", "checked", "issued", "grouped", "prefixed", "own_word", "benign_word", "date", "marked", "ending", "spoken", "variety", "glued"]
SAMPLE_ROWS, ITERATIONS, DEPTH, STEP = 20_000, 24, 4, 0.3
#: What a threshold has to reach on the texts that were held back.
PRECISION = 0.98
_PLACED = "array<struct<start:int,end:int,value:string,before:string,after:string>>"


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value, before, after>> of the leftmost matches that do not overlap, by code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    numbered = let(F.split(text, pattern, -1), lambda parts: F.arrays_zip(found.alias("m"), F.slice(parts, 1, F.size(parts) - 1).alias("b"), F.slice(parts, 2, F.size(parts)).alias("a")))

    def place(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + F.length(x["b"])
        end = start + F.length(x["m"])
        return end, F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value"), F.right(x["b"], F.lit(CONTEXT)).alias("before"), F.left(x["a"], F.lit(CONTEXT)).alias("after"))

    placed = scan(numbered, F.lit(0), place, _PLACED[6:-1])
    return F.when(text.rlike(pattern), placed).otherwise(F.array().cast(_PLACED))


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _true(kind: str, value: Column) -> Column:
    """The check of a base pattern."""
    n = F.length(_digits(value))
    match kind:
        case "ip":
            return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
        case "card":
            return n.between(14, 19) & _luhn(_digits(value))
        case "phone":
            return n.between(10, 15)
        case _:
            return F.lit(True)


def _iban_holds(value: Column) -> Column:
    """Is the number, its first four characters moved to the end, 1 modulo 97?"""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    number = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.split(moved, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise((acc * F.when(c.between("0", "9"), 10).otherwise(100) + number(c)) % 97))
    return rest == 1


def features(kind: str, c: Column) -> Column:
    """array<double> of FEATURES for a candidate (value, before, after)."""
    value, before, after = c["value"], F.lower(c["before"]), F.lower(c["after"])
    number = lambda x: x.cast("int").cast("double")
    digits = _digits(value)
    match kind:
        case "card":
            checked = _luhn(digits)
        case "iban":
            checked = _iban_holds(value)
        case "ip":
            checked = value.rlike(r"[A-Fa-f].*:|::|:.*[A-Fa-f]|[(\[d]")
        case "email":
            checked = value.rlike(r"(?i)[(\[{<]|@|dot")
        case _:
            checked = F.lit(False)
    every = [
        *(F.lit(float(k == kind)) for k in KINDS),
        F.length(value).cast("double"),
        F.length(digits).cast("double"),
        F.length(F.regexp_replace(value, r"[^\p{L}]", "")).cast("double"),
        F.length(F.regexp_replace(value, r"[\p{L}0-9]", "")).cast("double"),
        number(checked),
        number(value.rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))")),
        number(value.rlike(r"^(?:[0-9]{4}[^0-9]{1,2}){3}[0-9]{4}$|^\(?[0-9]{3}\)?[-. /]{1,2}[0-9]{3}-[0-9]{4}$")),
        number(value.rlike(r"^(?:\+|00|\(|0[1-9])")),
        number(before.rlike(OWN_WORDS[kind])),
        number(before.rlike(BENIGN_WORDS)),
        number(value.rlike(r"^(?:(?:19|20)[0-9]{2}[-./][01]?[0-9][-./][0-3]?[0-9]|[0-3]?[0-9][-./][01]?[0-9][-./](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-(?:19|20)[0-9]{2})$")),
        number(before.rlike(r"[:=]\s*$")),
        number(value.rlike(rf"(?i)(?:\.|dot\)?\]?\s?){ENDINGS}$")),
        number(value.rlike(r"(?i)\bat\b|\bdot\b")),
        F.size(F.array_distinct(F.split(digits, ""))).cast("double"),
        number(before.rlike(r"[$€£#%/=_]$") | after.rlike(r"^(?:[%€$£]|[.,:/][0-9])")),
    ]
    return F.array(*[x.cast("double") for x in every])


def _either(text: Column, pattern: str, spans: Column) -> Column:
    """spans of the texts where the pattern, a cheap one, is found."""
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_PLACED))


def candidates(text: Column) -> list[Column]:
    """Of each generator array<struct<kind, start, end, f>>."""
    out = []
    for kind, pattern in GENERATORS:
        placed = matches(text, pattern)
        held = placed if kind == "email" else _either(text, "[0-9:]", placed)
        out.append(F.transform(held, _candidate(kind)))
    return out


def _candidate(kind: str) -> Callable[[Column], Column]:
    return lambda c: F.struct(F.lit(KINDS.index(kind)).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), features(kind, c).alias("f"))


def _base(text: Column, kind: str) -> Column:
    """array<struct<start, end, kind, score>> of the matches of a base pattern that hold."""
    good = F.filter(matches(text, BASE[kind]), lambda m: _true(kind, m["value"]))
    return F.transform(good, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(KINDS.index(kind)).alias("kind"), F.lit(2.0).alias("score")))


@dataclass(frozen=True)
class Model:
    """Boosted trees, their weights, and the threshold of each kind."""

    trees: list
    weights: list[float]
    thresholds: list[float]

    def score(self, f: Column) -> Column:
        def expression(tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            feature, bound, low, high = tree
            return F.when(f[feature] <= F.lit(bound), expression(low)).otherwise(expression(high))

        margin = reduce(lambda a, b: a + b, [expression(t) * F.lit(w) for t, w in zip(self.trees, self.weights, strict=True)])
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-2 * margin))

    def least(self, kind: Column) -> Column:
        return F.array(*[F.lit(t) for t in self.thresholds])[kind]


def described(texts: DataFrame) -> DataFrame:
    """(fold, kind, f, label) of the candidates of labelled texts (text, fold, spans array<struct<kind string, start, end>>): label 1
    where a span of that kind has those bounds."""
    found = texts.select("fold", "spans", F.explode(F.concat(*candidates(F.col("text")))).alias("c"))
    names = F.array(*[F.lit(k) for k in KINDS])
    same = F.exists("spans", lambda s: (s["kind"] == names[F.col("c.kind")]) & (s["start"] == F.col("c.start")) & (s["end"] == F.col("c.end")))
    return found.select("fold", "c.kind", "c.f", same.cast("int").alias("label"))


def fit(spark: SparkSession, texts: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS, precision: float = PRECISION) -> Model:
    """Trees learned from labelled texts (see ``described``), or from those of ``labelled_pii``: at most ``sample_rows`` candidates,
    of which the folds but 0 train and fold 0 sets the thresholds: of each kind the least score from which on
    ``precision`` of the candidates are personal data (above 1, so that none is added, if there is none)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    if texts is None:
        texts = spark.createDataFrame(labelled_pii.labelled_texts(), "text string, fold int, spans array<struct<kind:string,start:int,end:int>>")
    rows = described(texts).orderBy(F.xxhash64("fold", "kind", "f", "label"), "f", "label").limit(sample_rows).coalesce(1).cache()
    data = rows.where("fold <> 0").select(array_to_vector("f").alias("features"), F.col("label").cast("double").alias("label"))
    fitted = GBTClassifier(maxIter=ITERATIONS, maxDepth=DEPTH, stepSize=STEP, seed=11).fit(data)
    model = Model([_tree(t.toDebugString.splitlines()[1:]) for t in fitted.trees], [float(w) for w in fitted.treeWeights], [])
    held = rows.where("fold = 0").select("kind", "label", model.score(F.col("f")).alias("score")).collect()  # at most sample_rows
    rows.unpersist()
    thresholds = []
    for kind in range(len(KINDS)):
        seen = sorted(((r["score"], r["label"]) for r in held if r["kind"] == kind), reverse=True)
        least, good = math.inf, 0
        for i, (score, label) in enumerate(seen):
            good += label
            if good >= precision * (i + 1) and label and (i + 1 == len(seen) or seen[i + 1][0] < score):
                # Halfway to the next one below.
                least = (score + seen[i + 1][0]) / 2 if i + 1 < len(seen) else score
        thresholds.append(max(0.5, least) if least < math.inf else 2.0)
    return Model(model.trees, model.weights, thresholds)


def _added(base: Column, proposed: Column) -> Column:
    """Of the proposed (start, end, kind, score) those that overlap no base span, and of overlapping ones the best."""
    kind = "struct<start:int,end:int,kind:int,score:double>"
    every = F.array_sort(F.concat(base, proposed))
    # Forwards: the furthest end of the base spans that began before; backwards: the nearest start of one that begins after.
    free = scan(every, F.lit(0), lambda far, x: (F.when(x["score"] > 1, F.greatest(far, x["end"])).otherwise(far), F.when((x["score"] > 1) | (x["start"] >= far), x)), kind)
    back = F.reverse(F.filter(free, lambda x: x.isNotNull()))
    apart = scan(back, F.lit((1 << 31) - 1), lambda near, x: (F.when(x["score"] > 1, x["start"]).otherwise(near), F.when((x["score"] <= 1) & (x["end"] <= near), x)), kind)
    # One more at the end, so that the last is given out.
    last = F.array(F.struct(F.lit((1 << 31) - 1).alias("start"), F.lit((1 << 31) - 1).alias("end"), F.lit(0).alias("kind"), F.lit(0.0).alias("score")))
    ordered = F.concat(F.array_sort(F.filter(apart, lambda x: x.isNotNull())), last.cast(f"array<{kind}>"))
    better = lambda x, y: (x["score"] > y["score"]) | ((x["score"] == y["score"]) & (x["end"] - x["start"] > y["end"] - y["start"]))
    nobody = F.lit(None).cast(kind)
    chosen = scan(
        ordered,
        nobody,
        lambda now, x: (F.when(now.isNull() | (x["start"] >= now["end"]) | better(x, now), x).otherwise(now), F.when(now.isNotNull() & (x["start"] >= now["end"]), now)),
        kind,
    )
    return F.filter(chosen, lambda x: x.isNotNull())


def find(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and ``__base`` and ``__added``, arrays of (start, end, kind, score), by start.

    Spans are code points, end exclusive; a base span has the score 2.  Null and empty texts hold none; rows that
    repeat are searched each; texts of any length are searched whole; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    spans = "array<struct<start:int,end:int,kind:int,score:double>>"
    certain = [_base(text, kind) for kind in BASE]
    proposed = F.transform(F.concat(*candidates(text)), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), model.score(x["f"]).alias("score")))
    kept = [F.col(f"`{c}`") for c in keep]
    # One array after the other: each is made where the one before it is there.
    some = docs.select(*kept, F.array_sort(F.concat(*certain)).cast(spans).alias("__base"), F.filter(proposed, lambda x: x["score"] >= model.least(x["kind"])).cast(spans).alias("__proposed"))
    return some.select(*kept, "__base", F.when(F.size("__proposed") > 0, _added(F.col("__base"), F.col("__proposed"))).otherwise(F.array().cast(spans)).alias("__added"))


def _told(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added): the counts and the digest of the base spans, and all spans
    as text.  A null id stays null; other columns are ignored."""
    found = find(docs, model, [id_col], text_col)
    count = lambda k: F.size(F.filter("__base", lambda s: s["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(BASE)]
    return found.select(F.col(f"`{id_col}`"), *counts, F.sha2(_told(F.col("__base")).cast("binary"), 256).alias("base_sha256"), _told(F.concat("__base", "__added")).alias("spans"), F.size("__added").cast("long").alias("n_added"))


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs, all columns, with every span replaced by its kind in brackets; spans that overlap are one, named by the first.  Other
    texts are unchanged, null ones null."""
    columns = [f"c{i}" for i in range(len(docs.columns))]
    place = dict(zip(docs.columns, columns, strict=True))
    found = find(docs.toDF(*columns), model, columns, place[text_col])
    text, names = F.col(place[text_col]), F.array(*[F.lit(k.upper()) for k in KINDS])

    def cut_out(spans: Column, wide: Column) -> Column:
        piece = lambda a, b: F.decode(F.substr(wide, 4 * a + 1, 4 * (b - a)), "UTF-32")

        def step(at: Column, s: Column) -> tuple[Column, Column]:
            return F.greatest(at, s["end"]), F.when(s["start"] >= at, F.concat(piece(at, s["start"]), F.lit("["), names[s["kind"]], F.lit("]"))).otherwise("")

        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(scan(spans, F.lit(0), step, "string"), ""), piece(last, F.length(text)))

    # Four bytes a code point, made once: a piece is taken out without counting from the start.
    cleaned = let(F.array_sort(F.concat("__base", "__added")), lambda spans: let(F.encode(text, "UTF-32"), lambda wide: cut_out(spans, wide)))
    some = F.size("__base") + F.size("__added") > 0
    return found.select(*[(F.when(some, cleaned).otherwise(text) if name == text_col else F.col(c)).alias(name) for name, c in place.items()])
