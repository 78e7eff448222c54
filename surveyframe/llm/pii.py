"""Operator 1 - personal data, with DataFrame functions only.

Regular expressions propose spans, checksums (Luhn for cards, mod-97 for bank
accounts) and range checks confirm them, and words around a span adjust its
score. A span is kept when its score reaches ``THRESHOLD``.

Kinds: ``email``, ``ip``, ``card``, ``phone`` (the base kinds, always kept when
their check holds) and the added ``iban`` (mod-97) and ``ssn`` (three-two-four
digits, kept only beside a context word). Every kind is found leftmost and
non-overlapping over the whole text; a candidate that fails its check is
dropped and not retried.

The patterns are written so that Java's engine needs time linear in the text:
possessive loops, and a look-behind that starts a match only where a run of its
characters starts (or where the last match ended).

Null text: no spans. Extra columns pass through. Rows that repeat are treated
alike. The plan is one projection: no shuffle, and nothing depends on a key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Order of the kinds, patterns, context words (lower case).
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "iban", "ssn"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",  # a whole run of digits; shorter ones cannot pass
    "phone": r"\+[0-9](?:[\x20().-]*+[0-9]){7,}+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?:\x20[A-Z0-9]{4}){2,7}+(?:\x20[A-Z0-9]{1,3}+)?+)(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Characters without which a text has no match of the pattern.
HINTS = {"email": "@", "phone": "+", "ssn": "-"}
CONTEXT = {
    "email": "mail|contact|write|correo|courriel",
    "ip": "ip|server|host|address|login",
    "card": "card|visa|credit|payment|tarjeta|carte|karte",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|bank|account|konto|cuenta|compte",
    "ssn": "ssn|social|security|tax",
}
BASE_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT_BONUS = 0.2
CONTEXT_CHARS = 48
THRESHOLD = 0.5
_BLOCK = 256


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where a string of digits passes the Luhn check."""
    chars = F.split(F.reverse(digits), "")
    total = F.aggregate(F.transform(chars, lambda c, i: F.when(i % 2 == 0, c.cast("int"))
                                    .otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int"))),
                        F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """True where an account number (without spaces) leaves 1 when divided by 97."""
    moved = F.concat(F.substring(account, 5, 40), F.substring(account, 1, 4))
    return F.aggregate(F.split(moved, ""), F.lit(0),
                       lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.try_to_number(c, F.lit("9")).cast("int")) % 97)
                       .otherwise((a * 100 + F.ascii(c) - 55) % 97).cast("int")) == 1


def _valid(kind: str, m: Column) -> Column:
    d = _digits(m)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return m.rlike(f"^{part}(?:\\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(d).between(8, 15)
    if kind == "iban":
        plain = F.replace(m, F.lit(" "), F.lit(""))
        return F.when(F.length(plain).between(15, 34), mod97(plain)).otherwise(False)
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _starts(gaps: Column, matches: Column) -> Column:
    """Start of every match: running sums of gap and match lengths, in blocks so
    that copying the sums stays far below the square of their number."""
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches,
                       lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m")))

    def sums(block: Column, at: Column, first: Callable, step: Callable) -> Column:
        return F.aggregate(block, F.struct(at.alias("at"), F.array().cast("array<int>").alias("out")),
                           lambda s, x: F.struct((s["at"] + step(x)).alias("at"),
                                                 F.concat(s["out"], F.array(s["at"] + first(x))).alias("out")),
                           lambda s: s["out"])

    def in_blocks(all_steps: Column) -> Column:
        n_blocks = F.floor((F.size(matches) - 1) / _BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), n_blocks), lambda b: F.slice(all_steps, b * _BLOCK + 1, F.lit(_BLOCK)))

    def of_blocks(blocks: Column) -> Column:
        sizes = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x["g"] + x["m"]))
        offsets = sums(sizes, F.lit(0), lambda x: F.lit(0), lambda x: x)
        return F.flatten(F.zip_with(blocks, offsets, lambda b, at: sums(b, at, lambda x: x["g"], lambda x: x["g"] + x["m"])))

    return _let(_let(steps, in_blocks), of_blocks)


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """Add ``out``: an array of (kind, start, end, score, value), by kind as listed, then start.

    Positions count code points, the end is exclusive. Null text: an empty array.
    Columns of ``docs`` named like the helper columns are kept: helpers get a
    prefix that no table is expected to use and are dropped again.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("__pii_text", t)

    def matches_of(k: str) -> Column:
        found = F.regexp_extract_all("__pii_text", F.lit(PATTERNS[k]), F.lit(0))
        if k not in HINTS:
            return found
        return F.when(F.contains("__pii_text", F.lit(HINTS[k])), found).otherwise(F.array().cast("array<string>"))

    df = df.withColumns({f"__pii_m_{k}": matches_of(k) for k in KINDS})
    has = {k: F.size(f"__pii_m_{k}") > 0 for k in KINDS}
    df = df.withColumns({f"__pii_g_{k}": F.when(has[k], F.split("__pii_text", PATTERNS[k], -1)) for k in KINDS})
    df = df.withColumns({f"__pii_s_{k}": F.when(has[k], _starts(F.col(f"__pii_g_{k}"), F.col(f"__pii_m_{k}")))
                         for k in KINDS})

    def spans(k: str) -> Column:
        gaps, matches, starts = (F.col(f"__pii_{x}_{k}") for x in "gms")

        def one(m: Column, i: Column) -> Column:
            before = F.right(F.get(gaps, i), F.lit(CONTEXT_CHARS))
            after = F.left(F.get(gaps, i + 1), F.lit(CONTEXT_CHARS))
            near = F.lower(F.concat(before, F.lit(" "), after)).rlike(rf"\b(?:{CONTEXT[k]})")
            score = F.lit(BASE_SCORE[k]) + F.when(near, CONTEXT_BONUS).otherwise(0.0)
            return F.struct(F.lit(k).alias("kind"), F.get(starts, i).alias("start"),
                            (F.get(starts, i) + F.length(m)).alias("end"), score.alias("score"), m.alias("value"),
                            _valid(k, m).alias("ok"))

        kept = F.filter(F.transform(matches, one), lambda s: s["ok"] & (s["score"] >= THRESHOLD))
        cut = F.transform(kept, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                                   s["score"].alias("score"), s["value"].alias("value")))
        return F.when(has[k], cut).otherwise(
            F.array().cast("array<struct<kind:string,start:int,end:int,score:double,value:string>>"))

    df = df.withColumn(out, F.concat(*[spans(k) for k in KINDS]))
    return df.drop("__pii_text", *[f"__pii_{x}_{k}" for x in "gms" for k in KINDS])


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace every found span by its kind in brackets, such as ``[EMAIL]``.

    Spans that overlap become one, named by the one that starts first. Texts
    without spans, and null texts, stay as they are.
    """
    df = find_pii(docs, text, "__pii")
    order = F.array_sort(F.transform("__pii", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                                 s["kind"].alias("kind"))))
    src = F.col(text)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    masked = F.aggregate(
        order, start,
        lambda a, s: F.when(s["start"] >= a["at"], F.struct(
            s["end"].alias("at"), F.concat(a["out"], F.array(
                F.substring(src, a["at"] + 1, s["start"] - a["at"]),
                F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))).alias("out")))
        .otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(src, a["at"] + 1, F.length(src))))
    return df.withColumn(text, F.when(F.size("__pii") > 0, masked).otherwise(src)).drop("__pii")


def op1_query(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, all spans, mean score."""
    df = find_pii(docs.select("doc_id", "text"), "text", "pii")
    base = F.filter("pii", lambda s: s["kind"].isin(BASE_KINDS))
    def of_kind(k: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")

    return df.select("doc_id", *[of_kind(k) for k in BASE_KINDS],
                     F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("pii")).alias("spans"),
                     *[of_kind(k) for k in KINDS if k not in BASE_KINDS])
