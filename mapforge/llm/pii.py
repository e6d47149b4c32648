"""Personal data by weak supervision.

Base patterns find emails, IP addresses, card and phone numbers; looser patterns propose more spans.
On each span four labelers vote yes, no or nothing: the strict pattern, a gazetteer (top-level domains,
issuer and calling prefixes, address ranges), the words before it, and the characters around it.
Expectation-maximisation over the counts of vote patterns (at most 3^4 a kind, whatever the input)
estimates how reliable each labeler is; the spans' probabilities then train a naive Bayes classifier
on votes, length, neighbours and preceding word. A proposed span is added if the classifier gives it
at least ``threshold`` and it overlaps no base span; base spans always stay.

Only DataFrame functions. The patterns are possessive and looked behind so that a run of characters is
scanned once, however long it is, and finds what the plain patterns find: leftmost, non-overlapping.

Defined results: a null text is empty and has no spans; equal rows get equal results; offsets count
code points; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import let, with_text, written

_LOCAL = r"[A-Za-z0-9._%+-]"
#: Kind: (pattern, what a text must match to be searched). \G allows a start where the last match ended.
BASE = {
    "email": (rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
LOOSE = {
    "email": (rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+\x20?(?:\(at\)|\[at\]|\{{at\}})\x20?[A-Za-z0-9-]{{1,63}}+(?:\x20?(?:\(dot\)|\[dot\]|\{{dot\}}|\.)\x20?[A-Za-z0-9-]{{1,63}}+){{1,8}}+", r"[(\[{]at[)\]}]"),
    "card": (r"(?<![0-9.])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9.])", r"[0-9]{4}[./_][0-9]{4}[./_][0-9]{4}"),
    "phone": (r"(?<![0-9A-Za-z+.-])(?:\([2-9][0-9]{2}\)\x20?|[2-9][0-9]{2}[.\x20-])[2-9][0-9]{2}[.\x20-][0-9]{4}(?![0-9A-Za-z.-][0-9A-Za-z]|[0-9A-Za-z])", r"[0-9]{3}[.\x20-][0-9]{4}"),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
}
KINDS = ["email", "ip", "card", "phone", "ssn"]
#: Words that speak for and against a kind when they stand shortly before a span.
FOR = {
    "email": "e-?mail|mail|contact|write|correo|courriel|kontakt",
    "ip": "ip|address|host|server|from|client|adresse",
    "card": "card|visa|mastercard|amex|credit|debit|pay|karte|carte|tarjeta",
    "phone": "phone|tel|telephone|call|fax|mobile|cell|whatsapp|telefon|t.l.phone|tel.fono",
    "ssn": "ssn|social|security|taxpayer",
}
AGAINST = "version|build|release|order|invoice|isbn|issn|ticket|serial|sku|token|key|hash|commit|rev|section|chapter"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_VALID_IP = rf"^0*{_OCTET}(?:\.0*{_OCTET}){{3}}$"
_TLDS = "com|org|net|edu|gov|mil|info|biz|io|co|de|fr|es|uk|us|eu|it|nl|ch|at|be|ca|au|in|jp|cn|br|mx|ru|pl|se"
LABELERS = ["regex", "gazetteer", "context", "around"]
SPAN = "struct<kind:string,start:bigint,end:bigint,base:boolean,regex:int,gazetteer:int,context:int,around:int,word:string>"


def _find(text: Column, pattern: str, needs: str) -> Column:
    """Matches of a pattern as array<struct(value, start, end, before, after)>, in time linear in the text."""
    p = F.lit(pattern)
    pieces = F.split(text, pattern, -1)
    out = "array<struct<value:string,start:bigint,end:bigint,before:string,after:string>>"

    def place(found: Column) -> Column:
        def step(t: Column, i: Column) -> Column:
            value, gap = F.get(found["m"], i), F.get(found["p"], i)
            start = t["at"] + F.char_length(gap)
            return let(F.struct(start.alias("s"), (start + F.char_length(value)).alias("e")), lambda b: F.struct(
                b["e"].alias("at"),
                F.concat(t["out"], F.array(F.struct(value.alias("value"), b["s"].alias("start"), b["e"].alias("end"), F.right(gap, F.lit(32)).alias("before"), F.left(F.get(found["p"], i + 1), F.lit(2)).alias("after")))).alias("out"),
            ))

        n = F.size(found["m"])
        return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n - 1), F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(out).alias("out")), step, lambda t: t["out"])).otherwise(F.array().cast(out))

    hit = text.contains(needs) if needs == "@" else text.rlike(needs)
    return F.when(hit, let(F.struct(F.regexp_extract_all(text, p, F.lit(0)).alias("m"), pieces.alias("p")), place)).otherwise(F.array().cast(out))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _spans(kind: str, found: Column, base: bool) -> Column:
    """Spans with votes from matches; base matches that fail their check are dropped."""
    if base:
        check = {
            "email": lambda m: F.lit(True),
            "ip": lambda m: m["value"].rlike(_VALID_IP),
            "card": lambda m: let(_digits(m["value"]), lambda d: F.length(d).between(12, 19) & F.call_function("luhn_check", F.when(F.length(d).between(12, 19), d).otherwise("1"))),
            "phone": lambda m: F.length(_digits(m["value"])).between(9, 15),
        }[kind]
        found = F.filter(found, check)

    def strict(m: Column) -> Column:
        if base:
            return F.lit(1)
        if kind == "card":
            return _vote(F.call_function("luhn_check", _digits(m["value"])), F.lit(True))
        if kind == "ssn":
            return _vote(~m["value"].rlike("^(?:000|666|9)|-00-|-0000$"), F.lit(True))
        return F.lit(0)

    def gazetteer(m: Column) -> Column:
        v = m["value"]
        if kind == "email":
            return _vote(F.lower(v).rlike(rf"(?:\.|dot[)\]}}]\x20?)(?:{_TLDS})$"), F.lit(False))
        if kind == "ip":
            return _vote(~v.rlike(r"^0*(?:0|12[7]|22[4-9]|2[34][0-9]|25[0-5])\."), F.lit(True))
        if kind == "card":
            return _vote(_digits(v).rlike("^(?:4|5[1-5]|2[2-7]|3[47]|3[0568]|6)"), F.lit(True))
        if kind == "phone":
            return _vote(v.rlike(r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])") if base else _digits(v).rlike("^[2-9][0-9]{2}[2-9]"), F.lit(False))
        return F.lit(0)

    def votes(m: Column) -> Column:
        before = F.lower(m["before"])
        last = F.right(m["before"], F.lit(1))
        return F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), F.lit(base).alias("base"),
            strict(m).alias("regex"), gazetteer(m).alias("gazetteer"),
            _vote(before.rlike(rf"\b(?:{FOR[kind]})\b"), before.rlike(rf"\b(?:{AGAINST})\b")).alias("context"),
            _vote((last.rlike(r"[\s(\[<:;,\"']") | (F.length(last) == 0)) & ~m["after"].rlike(r"^[A-Za-z0-9_@]"), last.rlike("[A-Za-z0-9_]") | m["after"].rlike("^[A-Za-z0-9_@]")).alias("around"),
            F.lower(F.regexp_extract(m["before"], r"([A-Za-z]{1,32})[^A-Za-z]{0,3}$", 1)).alias("word"),
        )

    return F.transform(found, votes).cast(f"array<{SPAN}>")


def candidates(documents: DataFrame) -> DataFrame:
    """doc_id (with any other columns but text) and spans: base spans and proposed ones that overlap none of them."""
    rows = documents.withColumn("text", F.coalesce("text", F.lit("")))
    text = F.col("text")
    base = F.concat(*[_spans(k, _find(text, *p), True) for k, p in BASE.items()])
    loose = F.concat(*[_spans(k, _find(text, *p), False) for k, p in LOOSE.items()])
    rows = rows.withColumn("__base", base).withColumn("__loose", loose)
    free = F.filter("__loose", lambda s: ~F.exists(F.col("__base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return rows.withColumn("__spans", F.concat("__base", F.when(F.size("__loose") > 0, free).otherwise(F.col("__loose")))).drop("__base", "__loose")


def _features(s: Column) -> Column:
    """What the classifier sees of a span: a bounded set of names (the word is hashed to 64)."""
    k = s["kind"]
    parts = [F.concat(F.lit(f"{n}:"), k, F.lit(":"), s[n].cast("string")) for n in LABELERS]
    parts.append(F.concat(F.lit("length:"), k, F.lit(":"), F.least(F.lit(9), F.floor(F.log2((s["end"] - s["start"]).cast("double") + 1))).cast("string")))
    parts.append(F.concat(F.lit("word:"), k, F.lit(":"), F.pmod(F.xxhash64(s["word"]), F.lit(64)).cast("string")))
    return F.array(*parts)


Estimates = tuple[dict[str, float], dict[tuple[str, int, int], float]]


def _log_odds(estimates: Estimates, kind: str, votes: tuple[int, ...]) -> float:
    """Log odds that a span of a kind with these votes is real."""
    prior, vote = estimates
    return math.log(prior[kind] / (1 - prior[kind])) + sum(math.log(vote[x, v, 1] / vote[x, v, 0]) for x, v in zip(LABELERS, votes, strict=True))


def estimate(spans: DataFrame, rounds: int = 25) -> Estimates:
    """Expectation-maximisation over vote patterns: P(kind's span is real) and P(vote | labeler, truth).

    The patterns are counted once, distributed; their table (at most len(KINDS) * 3^4 rows) is all that the rounds read.
    """
    counted = spans.groupBy("kind", *LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = [(r["kind"], tuple(r[x] for x in LABELERS), r["n"]) for r in counted]
    start = {2: 0.9, 1: 0.6, 0: 0.4}
    real = [start.get(min(2, sum(votes)), 0.1) for _, votes, _ in patterns]
    prior: dict[str, float] = {}
    vote: dict[tuple[str, int, int], float] = {}
    for _ in range(rounds):
        was = dict(vote)
        weights = [(n * p, n * (1 - p)) for (_, _, n), p in zip(patterns, real, strict=True)]
        for k in KINDS:
            yes, no = (math.fsum(w[i] for (kind, _, _), w in zip(patterns, weights, strict=True) if kind == k) + 1.0 for i in (0, 1))
            prior[k] = yes / (yes + no)
        for i, x in enumerate(LABELERS):
            for y in (0, 1):
                # A labeler is taken to be right more often than wrong: its right votes start at three, others at one.
                each = {v: math.fsum(w[1 - y] for (_, votes, _), w in zip(patterns, weights, strict=True) if votes[i] == v) + 1.0 + 2.0 * (y == (v > 0)) * (v != 0) for v in (-1, 0, 1)}
                vote |= {(x, v, y): c / sum(each.values()) for v, c in each.items()}
        real = [1 / (1 + math.exp(-max(-500.0, min(500.0, _log_odds((prior, vote), k, votes))))) for k, votes, _ in patterns]
        if was and max(abs(was[i] - vote[i]) for i in vote) < 1e-4:
            break
    return prior, vote


def classifier(spans: DataFrame) -> tuple[float, dict[str, float]]:
    """Naive Bayes from the spans' probabilities: the log odds of all spans and of each feature (a bounded set)."""
    prior, vote = estimate(spans)
    odds = F.lit(0.0)
    for k in KINDS:
        odds = odds + F.when(F.col("kind") == k, math.log(prior[k] / (1 - prior[k]))).otherwise(0.0)
    for x in LABELERS:
        for v in (-1, 0, 1):
            odds = odds + F.when(F.col(x) == v, math.log(vote[x, v, 1] / vote[x, v, 0])).otherwise(0.0)
    p = 1 / (1 + F.exp(-odds))
    span = F.struct(*[F.col(c) for c in spans.columns])
    seen = spans.select(p.alias("p"), F.explode(_features(span)).alias("f")).groupBy("f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    table = {r["f"]: (r["yes"], r["no"]) for r in seen.collect()}  # at most (4 * 3 + 10 + 64) * len(KINDS)
    yes, no = (sum(c[i] for f, c in table.items() if f.startswith("length:")) + 1.0 for i in (0, 1))
    return math.log(yes / no), {f: math.log((a + 1.0) / (yes + 2.0)) - math.log((b + 1.0) / (no + 2.0)) for f, (a, b) in table.items()}


def find_pii(documents: DataFrame, threshold: float = 0.9, keep_text: bool = True) -> DataFrame:
    """documents (without text, if that isn't kept) with ``spans``: array<struct(kind, start, end, base)> ordered by start, then kind as in KINDS.

    The candidates of all documents are written to the scratch folder (without text: a few numbers a span), from
    which the labelers' reliabilities are estimated and the result is read.
    """
    found = candidates(documents)
    kept = written(found if keep_text else found.drop("text"), "pii-candidates")
    return _chosen(kept, kept.select(F.inline("__spans")), threshold)


def redacted(documents: DataFrame, threshold: float = 0.9) -> DataFrame:
    """documents with each span in text replaced by redact(). Candidates are found twice, so that no second copy of all texts is written."""
    rows = documents.select(F.struct("*").alias("row"), "text")
    found = candidates(rows)
    # Of the outer form Spark infers no filter by size, which would search every text once more.
    spans = written(found.select(F.inline_outer("__spans")).where("kind IS NOT NULL"), "pii-spans")
    chosen = _chosen(found, spans, threshold)
    return with_text(chosen.select("row", redact(F.col("text"), F.col("spans")).alias("text")), documents.columns)


def _chosen(found: DataFrame, training: DataFrame, threshold: float) -> DataFrame:
    """found with the base spans and those that the classifier trained on all candidates accepts."""
    start, weights = classifier(training)
    known = F.from_json(F.lit(json.dumps(weights)), "map<string,double>")
    odds = lambda s: F.aggregate(_features(s), F.lit(float(start)), lambda t, f: t + F.coalesce(F.try_element_at(known, f), F.lit(0.0)))
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    chosen = F.filter("__spans", lambda s: s["base"] | (odds(s) >= math.log(threshold / (1 - threshold))))
    spans = F.transform(F.array_sort(F.transform(chosen, lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("o"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base")))), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")))
    return found.withColumn("spans", F.when(F.size("__spans") > 0, spans).otherwise(F.array().cast("array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"))).drop("__spans")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """text with each span replaced by its kind in angle brackets; overlapping spans give one mark each and no text twice."""

    def step(t: Column, s: Column) -> Column:
        gap = F.when(s["start"] > t["at"], F.substring(text, (t["at"] + 1).cast("int"), (s["start"] - t["at"]).cast("int"))).otherwise("")
        return F.struct(F.greatest(t["at"], s["end"]).alias("at"), F.concat(t["out"], F.array(F.concat(gap, F.lit("<"), F.upper(s["kind"]), F.lit(">")))).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(spans, start, step, lambda t: F.concat(F.array_join(t["out"], ""), F.substring(text, (t["at"] + 1).cast("int"), F.lit((1 << 31) - 1))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
