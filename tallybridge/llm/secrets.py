"""Secret scan with a random forest that removes false findings (operator 6).

Built of DataFrame and SQL functions only.  A document that holds no candidate costs one regular
expression of each kind; in the others the candidates are found word by word, and values assigned to
a secret's name, keys of a known form and private key blocks in the whole text; they are described by length, character
classes and transitions between them, dictionary coverage, path and neighbouring words, and scored
by the trees of a random forest, written out as CASE expressions over those features.  Nothing is
shuffled and the corpus is read once.  The forest is trained by pyspark.ml from labelled findings: the
caller's, or those of ``labelled_secrets``, whose truth is known from how they were made.
"""

from __future__ import annotations

import functools
import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.llm import folds, labelled_secrets
from tallybridge.llm.folds import let

#: A candidate: 16 or more characters of keys and digests, with a digit among them (fixed value).
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}={0,2}"
#: Words of fixed meaning, in natural order.
SECRET_NAMES = "(?:access|apikey|api[_-]?key|auth|bearer|cred|jwt|key|passw|passwd|pwd|private|secret|session|signature|token)"
BENIGN_NAMES = "(?:account|build|card|checksum|commit|digest|file|hash|id|image|iban|md5|number|phone|ref|revision|sha|sha1|sha256|uuid|version)"
#: A value assigned to a secret's name, of any length and characters (groups 1 to 4: the value).
ASSIGNED = rf"""(?=[abcjkpst]){SECRET_NAMES}[a-z0-9_.-]*+["'`\]]*+\s*+(?::=|=>|[=:])\s*+(?:(?:bearer|basic)\s++)?(?:"([^"\n]+)"|'([^'\n]+)'|`([^`\n]+)`|([^\s"'`,;)\]}}]\S*?)(?=[,;.)\]}}"'`]*+(?:\s|\z)))"""
#: Keys of a known form, which may have no digit.
KNOWN = r"(?-i:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_\w{20,}|glpat-[\w-]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|[sr]k_(?:live|test)_[A-Za-z0-9]{10,}|AIza[\w-]{30,}|npm_[A-Za-z0-9]{30,}|eyJ[\w-]{8,}\.[\w.-]{8,})"
PRIVATE_KEY = r"-----BEGIN [a-z0-9 ]*PRIVATE KEY(?: BLOCK)?-----[\s\S]*?-----END [a-z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
#: The password of a user in an address (group 1).
CREDENTIALS = r"://[^\s:/@?#]++:([^\s/@]++)@"
SPAN = rf"(?i){PRIVATE_KEY}|://[^\s:/@?#]++:[^\s/@]++@|{ASSIGNED}|(?<![a-z0-9+/_-]){KNOWN}"
PLACEHOLDERS = "(?:changeme|default|demo|dummy|example|fake|fixture|invalid|mock|placeholder|redacted|replace|sample|test|xxxx|your)"
PATH_HINTS = "(?:doc|example|fixture|mock|sample|spec|test)"
#: Length of the words of the dictionary, and how many of a vocabulary's ids are looked at.
WORD_LENGTHS, VOCABULARY_IDS = (10, 9, 8, 7, 6, 5, 4), 10_000

FEATURES = ["length", "digits", "upper", "lower", "other", "transitions", "variety", "covered", "hex", "slashes", "hinted", "secret_name", "assigned", "quoted", "benign_name", "only_digits", "known", "placeholder"]
THRESHOLD = 0.5
#: Bound of the training sample in rows; findings beyond it do not train (all are scored).
SAMPLE_ROWS = 20_000
TREES, DEPTH = 20, 6


@functools.cache
def dictionary(path: str | None = None) -> dict[int, str]:
    """Words of a public vocabulary of lower case words (tokens that end in </w>), by length, as
    one text with a blank around each."""
    import public_tokenizers

    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    words = sorted(t[:-4] for t, i in vocab.items() if i < VOCABULARY_IDS and t.endswith("</w>") and t[:-4].isascii() and t[:-4].isalpha() and t[:-4].islower())
    return {n: " " + " ".join(w for w in words if len(w) == n) + " " for n in WORD_LENGTHS}


def _covered(value: Column) -> Column:
    """Characters of a value that words of the dictionary cover: each run of letters is read from
    left to right, the longest word first."""

    def of_run(run: Column) -> Column:
        def longest(at: Column) -> Column:
            found = F.lit(0)
            for n in reversed(WORD_LENGTHS):
                fits = at + n - 1 <= F.length(run)
                found = F.when(fits & F.contains(F.lit(dictionary()[n]), F.concat(F.lit(" "), F.substring(run, at, F.lit(n)), F.lit(" "))), n).otherwise(found)
            return found

        def step(acc: Column, at: Column) -> Column:
            n = F.when(at < acc["next"], 0).otherwise(longest(at))
            return F.struct(F.greatest(acc["next"], at + n).alias("next"), (acc["sum"] + n).alias("sum"))

        start = F.struct(F.lit(1).alias("next"), F.lit(0).alias("sum"))
        return F.aggregate(F.sequence(F.lit(1), F.length(run) - 3), start, step, lambda a: a["sum"])

    runs = F.regexp_extract_all(F.lower(value), F.lit("[a-z]{4,}"), F.lit(0))
    return F.aggregate(runs, F.lit(0), lambda acc, run: acc + of_run(run))


def _share(value: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(value, pattern, "")).cast("double") / F.length(value)


def _features(value: Column, word: Column, before: Column, before2: Column, path: Column, left: Column | None = None) -> list[Column]:
    number = lambda c: c.cast("int").cast("double")
    left = F.split_part(word, value, F.lit(1)) if left is None else left
    name = F.lower(F.concat_ws(" ", before2, before, left))
    close = F.concat_ws(" ", before, left)
    body = F.regexp_replace(value, "-----[^-]*-----", "")  # the marks of a private key are words
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "l"), "[A-Z]", "u"), "[0-9]", "d"), "[^lud]", "o")
    changes = F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1
    return [
        F.length(value).cast("double"),
        _share(value, "[^0-9]"),
        _share(value, "[^A-Z]"),
        _share(value, "[^a-z]"),
        _share(value, "[A-Za-z0-9]"),
        changes.cast("double") / F.length(value),
        F.size(F.array_distinct(F.split(value, ""))).cast("double") / F.length(value),
        _covered(body).cast("double") / F.length(value),
        number(value.rlike("^[0-9a-fA-F]+$")),
        F.length(F.regexp_replace(value, "[^/]", "")).cast("double"),
        number(F.lower(F.coalesce(path, F.lit(""))).rlike(PATH_HINTS)),
        number(name.rlike(rf"{SECRET_NAMES}|://[^/\s]*:$")),
        number(close.rlike("[=:]")),
        number(left.rlike("[\"'`]$")),
        number(name.rlike(rf"\b{BENIGN_NAMES}\b")),
        number(value.rlike("^[0-9]+$")),
        number(value.rlike(f"^(?:{KNOWN}|-----BEGIN )")),
        number(F.lower(value).rlike(PLACEHOLDERS)),
    ]


def _described(text: Column, words: Column, path: Column) -> Column:
    """array<struct<word_no, secret, f array<double>, at, lead, span>> of the candidates: those of
    the words, with at = 0, then those of a span of the text, at its character ``at`` (from 1)
    with ``lead`` characters before the secret; an equal one of a word is not told twice."""
    numbered = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    hits = F.filter(numbered, lambda s: s["w"].rlike(CANDIDATE))

    def of_word(s: Column) -> Column:
        values = F.regexp_extract_all(s["w"], F.lit(CANDIDATE), F.lit(0))
        return F.transform(values, lambda v: F.struct(s["i"].alias("word_no"), v.alias("secret"), F.array(*_features(v, s["w"], F.get(words, s["i"] - 1), F.get(words, s["i"] - 2), path)).alias("f"), F.lit(0).alias("at"), F.lit(0).alias("lead"), v.alias("span")))

    # Places and word numbers are running sums over the spans and what lies between them: one pass, however many there are.
    # A span begins and ends with no white space, so no run of it is counted twice.
    runs = lambda x: F.size(F.split(x, r"[\x20\x09-\x0D]+")) - 1
    found = F.regexp_extract_all(text, F.lit(SPAN), F.lit(0))
    pairs = let(F.split(text, SPAN, -1), lambda between: F.arrays_zip(found.alias("span"), F.slice(between, 1, F.size(between) - 1).alias("gap")))

    def place(before: Column, x: Column) -> tuple[Column, Column]:
        at, words_before = before["at"] + F.length(x["gap"]), before["words"] + runs(x["gap"])
        after = F.struct((at + F.length(x["span"])).alias("at"), (words_before + runs(x["span"])).alias("words"))
        return after, F.struct(at.alias("at"), x["span"].alias("span"), words_before.alias("words"))

    spans = F.when(text.rlike(SPAN), folds.scan(pairs, F.struct(F.lit(1).alias("at"), F.lit(0).alias("words")), place, "struct<at:int,span:string,words:int>")).otherwise(F.array().cast("array<struct<at:int,span:string,words:int>>"))

    def of_span(p: Column) -> Column:
        groups = F.concat(*[F.regexp_extract(p["span"], f"(?i)^{ASSIGNED}$", g) for g in (1, 2, 3, 4)])
        login = F.regexp_extract(p["span"], f"^{CREDENTIALS}$", 1)
        groups = F.when(login != "", login).otherwise(groups)
        value = F.when(groups == "", p["span"]).otherwise(groups)
        close = F.length(F.regexp_extract(p["span"], "[\"'`@]$", 0))
        lead = F.when(groups == "", 0).otherwise(F.length(p["span"]) - F.length(value) - F.when(p["span"].endswith(value), 0).otherwise(close))
        return F.struct(p["at"].alias("at"), lead.alias("lead"), p["span"].alias("span"), value.alias("v"), p["words"].alias("words"))

    def told(p: Column) -> Column:
        lead = F.substring(p["span"], F.lit(1), p["lead"])
        word_no = p["words"] + runs(lead)
        f = F.array(*_features(p["v"], F.concat(lead, p["v"]), F.lit(""), F.lit(""), path, lead))
        return F.struct(word_no.alias("word_no"), p["v"].alias("secret"), f.alias("f"), p["at"].alias("at"), p["lead"].alias("lead"), p["span"].alias("span"))

    more = F.filter(F.transform(spans, of_span), lambda p: ~p["v"].rlike(f"^(?:{CANDIDATE})$"))
    return F.concat(F.flatten(F.transform(hits, of_word)), F.transform(more, told))


def describe(docs: DataFrame, keep: list[str], text_col: str = "text", path_col: str | None = "source", only: bool = False) -> DataFrame:
    """The columns ``keep`` and ``__found``, the described candidates of the whole text (null if
    there is none); with ``only``, rows without candidates are left out."""
    text = F.col(f"`{text_col}`")
    path = F.col(f"`{path_col}`").cast("string") if path_col and path_col in docs.columns else F.lit(None).cast("string")
    words = F.split(text, r"[\x20\x09-\x0D]+")
    kept = [F.col(f"`{c}`") for c in keep]
    held = text.rlike(CANDIDATE) | text.rlike(SPAN)
    if only:
        return docs.where(held).select(*kept, _described(text, words, path).alias("__found"))
    at = docs.select(*kept, F.when(held, text).alias("__text"), F.when(held, words).alias("__words"), path.alias("__path"))
    return at.select(*kept, F.when(F.col("__words").isNotNull(), _described(F.col("__text"), F.col("__words"), F.col("__path"))).alias("__found"))


def labelled(spark: SparkSession, families: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """(f, label) of the findings of ``labelled_secrets``, of some families or all."""
    rows = [r for r in labelled_secrets.findings() if families is None or r[3] in families]
    table = spark.createDataFrame(rows, "text string, source string, label int, family string")
    return describe(table, ["label"]).select("label", F.explode("__found").alias("c")).select("c.f", "label")


def train(findings: DataFrame, sample_rows: int = SAMPLE_ROWS, trees: int = TREES, depth: int = DEPTH, seed: int = 11) -> list:
    """Trees of a random forest over (f, label): nested (feature, bound, left, right) or a vote."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    chosen = findings.orderBy(F.xxhash64("f", "label"), "f", "label").limit(sample_rows).coalesce(1)
    data = chosen.select(array_to_vector("f").alias("features"), F.col("label").cast("double").alias("label"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird").fit(data)
    return [_tree(t.toDebugString.splitlines()[1:]) for t in forest.trees]


def _tree(lines: list[str]):
    rows = iter([x.strip() for x in lines if x.strip()])

    def node():
        row = next(rows)
        if row.startswith("Predict"):
            return float(row.split(":")[1])
        feature, bound = re.match(r"If \(feature (\d+) <= ([-+.\dEe]+)\)", row).groups()
        low = node()
        next(rows)  # Else
        return int(feature), float(bound), low, node()

    return node()


def vote(forest: list, f: Column) -> Column:
    """Share of the trees that call the finding a secret."""

    def expression(tree) -> Column:
        if isinstance(tree, float):
            return F.lit(tree)
        feature, bound, low, high = tree
        return F.when(f[feature] <= F.lit(bound), expression(low)).otherwise(expression(high))

    return reduce(lambda a, b: a + b, [expression(t) for t in forest]) / F.lit(float(len(forest)))


def fit(spark: SparkSession, findings: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS) -> list:
    """The forest learned from labelled findings (f, label), or from those of ``labelled_secrets``."""
    return train(labelled(spark) if findings is None else findings, sample_rows)


def scan(docs: DataFrame, forest: list, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", threshold: float = THRESHOLD) -> DataFrame:
    """(id, word_no, secret, score, predicted): every candidate of every whole text.

    word_no counts the words from 0; predicted is 1 if at least ``threshold`` of the trees say so.
    Null and empty texts hold none; a null path says nothing; null ids stay null; rows that repeat
    are scanned each; other columns are ignored; an empty table gives an empty result.
    """
    # explode would be given a filter on __found, which describes every candidate once more.
    found = describe(docs, [id_col], text_col, path_col, only=True).select(F.col(f"`{id_col}`"), F.explode_outer("__found").alias("c")).where("c is not null")
    scored = found.select(F.col(f"`{id_col}`"), "c.word_no", "c.secret", F.round(vote(forest, F.col("c.f")), 6).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def redact(docs: DataFrame, forest: list, text_col: str = "text", path_col: str | None = "source", threshold: float = THRESHOLD, mark: str = "[SECRET]") -> DataFrame:
    """docs, all columns, with every predicted secret in the text replaced; other texts unchanged."""
    # Columns go by their place, so that none is called like ours.
    columns = [f"c{i}" for i in range(len(docs.columns))]
    place = dict(zip(docs.columns, columns, strict=True))
    at = describe(docs.toDF(*columns), columns, place[text_col], place.get(path_col))
    text = F.col(place[text_col])
    of = lambda spans: F.filter(F.filter("__found", lambda c: (c["at"] > 0) == spans), lambda c: vote(forest, c["f"]) >= threshold)

    # Spans by their place, for their secrets may be short; then the others wherever they are.
    def cut_out(found: Column, wide: Column) -> Column:
        piece = lambda a, b: F.decode(F.substr(wide, 4 * a - 3, 4 * (b - a)), "UTF-32")

        def put(at: Column, c: Column) -> tuple[Column, Column]:
            begin = c["at"] + c["lead"]
            return begin + F.length(c["secret"]), F.concat(piece(at, begin), F.lit(mark))

        last = F.element_at(found, -1)
        rest = piece(last["at"] + last["lead"] + F.length(last["secret"]), F.length(text) + 1)
        return F.concat(F.array_join(folds.scan(found, F.lit(1), put, "string"), ""), rest)

    # Four bytes a code point, made once: a piece is taken out without counting from the start.
    spans = let(of(True), lambda found: F.when(F.size(found) > 0, let(F.encode(text, "UTF-32"), lambda wide: cut_out(found, wide))).otherwise(text))
    longest = F.array_sort(F.transform(of(False), lambda c: F.struct((-F.length(c["secret"])).alias("n"), c["secret"].alias("v"))))
    cleaned = F.when(F.size("__found") > 0, F.aggregate(longest, spans, lambda t, c: F.replace(t, c["v"], F.lit(mark)))).otherwise(text)
    return at.select(*[(cleaned if name == text_col else F.col(c)).alias(name) for name, c in place.items()])
