"""Personal data: wide generators propose spans, boosted trees and calibrated thresholds choose among them.

Four kinds have a strict form (email, ip, card, phone); their valid matches are always taken.
Around them, wide generators propose spans that may overlap those and each other: anything with
an at sign, dotted quads of any size, digit runs, plus-sign runs and long mixed tokens. What a
proposal looks like (format) and what stands around it (context) is reduced to a code of a
small finite set, at most CODES of them. The corpus is counted by code: how often a proposal of
that code passes its validator (Luhn sum, octet range, digit count, hexadecimal key), which is
not among the features. Boosted trees are fitted to these counts, so the fit covers every
proposal of every document, and its cost does not grow with the corpus. Per generator, a
threshold on the score is set on documents kept out of the fit, where the accepted codes reach
PRECISION. Proposals of accepted codes that are not strict matches and do not overlap one are
added: a card number with a typo among card numbers, a key after "token =".

Everything runs in built-in expressions; the fit is pyspark.ml's. No text is shuffled.

Edge cases: a missing text is an empty one without spans; ids may be missing or repeated, rows
are independent; other columns are never read. Without proposals, or where no code reaches the
precision, nothing is added. Positions count code points from 0, ends are exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark.llm.common import documents
from sensorspark.plans.shared import materialize

PRECISION = 0.9
TREES, DEPTH, STEP = 10, 4, 0.5
KINDS = ("email", "ip", "card", "phone")
EXTRA = ("mail_like", "ip_like", "number", "phone_like", "secret")
CONTEXT = 24
_BLOCK = 256
_SPANS = "array<struct<start:bigint,end:bigint,m:string>>"

# Possessive forms of the contract's patterns: same matches, no backtracking and no deep recursion.
# A local part or number is only tried where it begins (or where the last match ended), so that
# a long run without a match costs one pass.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
MAIL_LIKE = r"(?:(?<![^\s@<>\"'(),;])|\G)[^\s@<>\"'(),;]++@[^\s@<>\"'(),;]++"
SECRET = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}+"
MIN_DIGITS = 7

# Context cues by meaning; the first that is found counts.
CUES = (r"(?:token|key|secret|passw|pwd|auth|bearer)", r"(?:card|visa|master|amex|iban|account|konto|compte|cuenta)",
        r"(?:call|phone|tel|mobil|fax|cell|whatsapp)", r"(?:mail|contact|@)")
# Sizes of the code's digits: generator, length, digits, letters, separators, cue, char before, char after.
_SIZES = (len(EXTRA), 8, 7, 4, 3, len(CUES) + 1, 6, 4)
FEATURES = ("generator", "length", "digits", "letters", "separators", "cue", "before", "after")
CODES = 1
for _size in _SIZES:
    CODES *= _size


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once for all its uses."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column) -> Column:
    """Running sums of an array, in blocks so that long arrays cost little more than their length."""
    def fold(part: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(part, start, lambda a, v: F.struct(
            (a["sum"] + v).alias("sum"), F.concat(a["out"], F.array(a["sum"] + v)).alias("out")))["out"]

    blocks = F.transform(F.sequence(F.lit(1), F.size(values), F.lit(_BLOCK)), lambda at: fold(F.slice(values, at, _BLOCK)))
    return _let(blocks, lambda bs: _let(fold(F.transform(bs, lambda b: F.element_at(b, -1))), lambda ends: F.flatten(
        F.transform(bs, lambda b, i: F.transform(b, lambda v: v + F.when(i > 0, ends[i - 1]).otherwise(0))))))


def find(text: Column, pattern: str, possible: Column) -> Column:
    """Array of (start, end, m) of the leftmost non-overlapping matches; `possible` is a cheap necessary condition."""
    def located(found: Column) -> Column:
        between = F.transform(F.split(text, pattern, -1), lambda p: F.length(p).cast("bigint"))
        return _let(between, lambda gaps: _let(
            _running(F.transform(found, lambda m, i: F.get(gaps, i) + F.when(
                i > 0, F.length(F.get(found, i - 1))).otherwise(0))),
            lambda starts: F.transform(found, lambda m, i: F.struct(
                F.get(starts, i).alias("start"), (F.get(starts, i) + F.length(m)).alias("end"), m.alias("m")))))

    none = F.array().cast(_SPANS)
    return F.when(possible, _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(
        F.size(found) > 0, located(found)).otherwise(none))).otherwise(none)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((F.length(digits) - i) % 2 == 1, doubled).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + value(i))
    return total % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) < 3) | (
            (F.length(part(p)) == 3) & (part(p) <= "255")))
    if kind == "card":
        return _let(_digits(m), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False))
    return F.length(_digits(m)).between(9, 15)


def _bucket(value: Column, *cuts: int) -> Column:
    out = F.lit(len(cuts))
    for i, cut in reversed(list(enumerate(cuts))):
        out = F.when(value < cut, i).otherwise(out)
    return out


def _code(generator: int, text: Column, span: Column) -> Column:
    """The finite code of a proposal: format and context, and nothing of its validator."""
    m = span["m"]
    left = F.lower(F.substr(text, F.greatest(span["start"] - CONTEXT, F.lit(0)) + 1,
                            F.least(span["start"], F.lit(CONTEXT))))
    before, after = F.substr(text, span["start"], F.lit(1)), F.substr(text, span["end"] + 1, F.lit(1))
    before = F.when(span["start"] == 0, F.lit("")).otherwise(before)
    cue = F.lit(len(CUES))
    for i, words in reversed(list(enumerate(CUES))):
        cue = F.when(left.rlike(words), i).otherwise(cue)
    kind = lambda c: (F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike("[\"'`]"), 2)
                      .when(c.rlike("[=:]"), 3).when(c.rlike(r"[\p{L}\p{N}]"), 4).otherwise(5))
    parts = (F.lit(generator), _bucket(F.length(m), 9, 13, 16, 20, 28, 36, 48),
             _bucket(F.length(_digits(m)), 1, 7, 9, 13, 20, 32), _bucket(F.length(F.regexp_replace(m, "[^A-Za-z]", "")), 1, 6, 16),
             _bucket(F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")), 1, 3), cue, kind(before), F.least(kind(after), F.lit(3)))
    code = F.lit(0)
    for size, part in zip(_SIZES, parts, strict=True):
        code = code * size + part
    return code.cast("int")


def with_proposals(docs: DataFrame) -> DataFrame:
    """(doc_id, text, strict, proposals) for (doc_id, text).

    `strict` has (kind, start, end) of the valid matches by kind, then start; `proposals` has
    (generator, start, end, code, valid) of everything the wide generators find.
    """
    text = F.col("text")
    digit = text.rlike("[0-9]")
    hits = docs.withColumns({
        "email": find(text, EMAIL, F.contains(text, F.lit("@"))),
        "mail": find(text, MAIL_LIKE, F.contains(text, F.lit("@"))),
        "ip": find(text, IP, digit & text.rlike(r"[0-9]\.[0-9]")),
        "card": find(text, CARD, digit),
        "phone": find(text, PHONE, F.contains(text, F.lit("+"))),
        "secret": find(text, SECRET, digit & text.rlike("[A-Za-z0-9_-]{16}")),
    })
    def strict_of(kind: str) -> Column:
        return F.transform(F.filter(F.col(kind), lambda s: _valid(kind, s["m"])), lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    strict = F.concat(*map(strict_of, KINDS))

    def wide(generator: int, spans: Column, possible: Callable, valid: Callable) -> Column:
        return F.transform(F.filter(spans, possible), lambda s: F.struct(
            F.lit(generator).alias("generator"), s["start"].alias("start"), s["end"].alias("end"),
            _code(generator, text, s).alias("code"), valid(s["m"]).alias("valid")))

    many = lambda s: F.length(_digits(s["m"])) >= MIN_DIGITS
    mixed = lambda s: s["m"].rlike("[0-9]") & s["m"].rlike("[A-Za-z]")
    proposals = F.concat(
        wide(0, F.col("mail"), lambda s: F.lit(True), lambda m: m.rlike(EMAIL)),
        wide(1, F.col("ip"), lambda s: F.lit(True), lambda m: _valid("ip", m)),
        wide(2, F.col("card"), many, lambda m: _valid("card", m)),
        wide(3, F.col("phone"), lambda s: F.lit(True), lambda m: _valid("phone", m)),
        wide(4, F.col("secret"), mixed, lambda m: m.rlike("^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$")))
    return hits.select("doc_id", "text", strict.alias("strict"), proposals.alias("proposals"))


@dataclass(frozen=True)
class Selector:
    """Codes whose proposals are taken; at most CODES."""

    codes: tuple[int, ...]


def fit(proposed: DataFrame, precision: float = PRECISION, trees: int = TREES, depth: int = DEPTH) -> Selector:
    """Boosted trees over the counts by code, then one threshold per generator."""
    held_out = F.pmod(F.xxhash64("doc_id", "text"), F.lit(5)) == 0
    each = proposed.select(held_out.alias("held_out"), F.explode("proposals").alias("p"))
    count = lambda when: F.sum(F.when(when, 1).otherwise(0))
    valid = F.col("p.valid")
    counted = materialize(each.groupBy(F.col("p.code").alias("code")).agg(
        count(~F.col("held_out") & valid).alias("pos"), count(~F.col("held_out") & ~valid).alias("neg"),
        count(F.col("held_out") & valid).alias("pos_out"), count(F.col("held_out") & ~valid).alias("neg_out")).coalesce(1), "codes")
    rest, digits = F.col("code"), {}
    for name, size in reversed(list(zip(FEATURES, _SIZES, strict=True))):
        digits[name] = (rest % size).cast("double")
        rest = F.floor(rest / size)
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(counted.withColumns(digits))
    rows = table.selectExpr("features", "inline(array(struct(1D as label, cast(pos as double) as weight), "
                                        "struct(0D as label, cast(neg as double) as weight)))").filter("weight > 0")
    present = {r[0] for r in rows.select("label").distinct().collect()}
    if len(present) < 2:
        scored = table.withColumn("score", F.lit(1.0 if 1.0 in present else 0.0))
    else:
        model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=STEP, weightCol="weight", seed=7).fit(rows)
        scored = model.transform(table).withColumn("score", vector_to_array("probability")[1])
    # At most CODES rows come to the driver, however large the corpus.
    found = scored.select("code", F.col("generator").cast("int"), "score", "pos_out", "neg_out", "pos", "neg").collect()
    chosen: list[int] = []
    for generator in range(len(EXTRA)):
        own = sorted((r for r in found if r["generator"] == generator), key=lambda r: (-r["score"], r["code"]))
        threshold, good, bad, at = None, 0, 0, 0
        while at < len(own):
            score = own[at]["score"]
            while at < len(own) and own[at]["score"] == score:  # codes of one score stand or fall together
                good, bad, at = good + own[at]["pos_out"], bad + own[at]["neg_out"], at + 1
            if good and good >= precision * (good + bad):
                threshold = score
        chosen += [r["code"] for r in own if threshold is not None and r["score"] >= threshold]
    return Selector(tuple(sorted(chosen)))


def choose(proposed: DataFrame, selector: Selector) -> DataFrame:
    """(doc_id, text, strict, spans): strict spans, then the added ones, by kind and start."""
    taken = F.filter("proposals", lambda p: p["code"].isin(list(selector.codes)) & (~p["valid"] | (p["generator"] == 4))) \
        if selector.codes else F.filter("proposals", lambda p: F.lit(False))
    free = F.filter(taken, lambda p: ~F.exists("strict", lambda s: (s["start"] < p["end"]) & (p["start"] < s["end"])))
    names = F.array(*[F.lit(k) for k in EXTRA])
    added = F.transform(free, lambda p: F.struct(F.get(names, p["generator"]).alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    return proposed.select("doc_id", "text", "strict", F.concat("strict", added).alias("spans"))


def detect(df: DataFrame, text: str = "text", doc_id: str = "doc_id", precision: float = PRECISION) -> DataFrame:
    """(doc_id, text, strict, spans) of every row, with a selector fitted to the input itself."""
    proposed = with_proposals(documents(df, text, doc_id))
    return choose(proposed, fit(proposed, precision))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans give one mark."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))
    folded = F.aggregate(ordered, start, lambda a, s: F.struct(
        F.greatest(a["at"], s["end"]).alias("at"),
        F.when(s["start"] < a["at"], a["parts"]).otherwise(F.concat(a["parts"], F.array(
            F.substr(text, a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))).alias("parts")))
    whole = _let(folded, lambda f: F.concat(F.array_join(f["parts"], ""), F.substr(text, f["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def redact(df: DataFrame, text: str = "text", precision: float = PRECISION) -> DataFrame:
    """The input with spans of its text column replaced; other columns and missing texts as they came."""
    names = list(df.columns)
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    proposed = with_proposals(packed)
    chosen = choose(proposed, fit(proposed, precision))
    new = F.when(F.col(f"doc_id.`{text}`").isNotNull(), redacted(F.col("text"), F.col("spans")))
    return chosen.select(*[new.alias(c) if c == text else F.col(f"doc_id.`{c}`").alias(c) for c in names])
