"""URL filters: rules first, else naive Bayes over the words of segmented hosts and paths.

Host names run words together. A unigram model, counted over the visible text of all pages, splits each
piece of a host by Viterbi into the likeliest words. A URL's tokens are these words, the host's labels
and the path's words (numbers count as one token). The URLs that a rule judges are the labelled ones: their
verdicts teach multinomial naive Bayes over tokens, which then scores every URL, so what a rule blocks in one
place counts against its like in others.

Nothing that grows is broadcast: the unigrams that a piece needs are found by a join on its substrings,
token weights by a join on tokens, with the most frequent tokens (a bounded number) looked up apart.

Defined results: a null url or one without ``://`` has an empty host and path and is judged by the prior;
equal urls get equal verdicts; the longest fitting rule wins, of equally long ones the first by code
point; tokens that no labelled URL has count for nothing; a score of 0 or less allows, and without labelled
URLs of both verdicts the method allows all; a run of letters longer than a host name may be (253) is one word;
equally likely splits go to the one whose last word is longest; very long urls are tokens like others; no rows
give no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import lookup, measured, written

#: Host names have at most so many characters (RFC 1035).
HOST = 253


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.lit((1 << 31) - 1))).otherwise("")


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; nulls if none does. Rules read like ``example.com/en/``."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r), [-ord(c) for c in r])):  # the last that fits is kept
        name, _, rest = r.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, r).otherwise(rule), F.when(fits, rules[r]).otherwise(verdict)
    return rule, verdict


def viterbi(piece: str, counts: dict[str, int], total: int) -> list[str]:
    """The likeliest words that make up piece; an unknown word of n letters has probability 10 / (total * 10^n)."""
    log_total, ten = math.log(max(total, 1)), math.log(10)
    longest = max(map(len, counts), default=0)
    best, back = [0.0], [0]
    unknown, since = 0.0, 0  # the best start of an unknown word: largest best[start] + start * ten
    for end in range(1, len(piece) + 1):
        score, start = unknown + (1 - end) * ten - log_total, since
        for at in range(max(0, end - longest), end):
            n = counts.get(piece[at:end], 0)
            if n and (p := best[at] + math.log(n) - log_total) > score:
                score, start = p, at
        best.append(score)
        back.append(start)
        if score + end * ten > unknown:
            unknown, since = score + end * ten, end
    words, end = [], len(piece)
    while end:
        words.append(piece[back[end] : end])
        end = back[end]
    return words[::-1]


def unigrams(pages: DataFrame) -> DataFrame:
    """(word, n): lower-case a-z words of all pages' visible text, as long as a host name may be."""
    text = F.lower(F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<(script|style)\b.*?</\1>", " "), r"<[^>]*>", " "))
    words = pages.select(F.explode(F.regexp_extract_all(text, F.lit("[a-z]++"), F.lit(0))).alias("word"))
    return words.where(F.length("word") <= HOST).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def segmented(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """(host, words): the words of each distinct host's pieces, by the unigram counts (word, n), a written table."""
    seen = words.agg(F.sum("n"), F.max(F.length("word"))).first()
    total, longest = seen[0] or 0, seen[1] or 1
    pieces = hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit("[a-z]++"), F.lit(0))).alias("at", "piece"))
    distinct = pieces.select("piece").distinct()
    length = F.char_length("piece")
    starts = distinct.where(length <= HOST).select("piece", F.explode(F.sequence(F.lit(1), length)).alias("s"), length.alias("l"))
    parts = starts.select("piece", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), F.col("l") - F.col("s") + 1)), lambda k: F.substring(F.col("piece"), F.col("s"), k))).alias("word")).distinct()
    known = parts.join(words, "word").groupBy("piece").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("known"))

    @F.pandas_udf("array<string>")
    def cut(piece: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series([[p] if len(p) > HOST else viterbi(p, dict(c) if c is not None else {}, total) for p, c in zip(piece, counts, strict=True)])

    split = distinct.join(known, "piece", "left").select("piece", cut("piece", "known").alias("words"))
    both = pieces.join(split, "piece").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("at", "words"))).alias("p"))
    return both.select("host", F.flatten(F.col("p.words")).alias("words"))


def judge(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the classifier's log odds of block) of (page_id, url, html)."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumn("k", F.sha2(F.concat_ws("\u0000", "host", "path"), 256))
    urls = rows.groupBy("k").agg(F.first("host").alias("host"), F.first("path").alias("path"), F.count(F.lit(1)).alias("n"))
    urls, seen = measured(urls, "urls", F.sum("n").alias("pages"))
    hosts = urls.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    named = written(hosts.join(segmented(hosts.select("host"), written(unigrams(pages), "url-unigrams")), "host", "left"), "url-hosts")
    known = lookup(urls.withColumnRenamed("n", "pages"), named, "host", "n", seen["n"])
    path_words = F.regexp_extract_all(F.lower("path"), F.lit(r"[a-z]++|[0-9]++"), F.lit(0))
    labels = F.transform(F.filter(F.split("host", r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("."), x))
    tokens = F.concat(F.coalesce("words", F.array().cast("array<string>")), labels, F.transform(path_words, lambda w: F.when(w.rlike("^[0-9]"), "/#").otherwise(F.concat(F.lit("/"), w))))
    verdict = rule_of(F.col("host"), F.col("path"), rules)[1]
    block = F.when(verdict.isNotNull(), (verdict == "block").cast("int")).alias("block")
    held = written(known.select("k", "pages", block, F.explode(tokens).alias("token")), "url-tokens")
    b, a = F.coalesce(F.col("pages") * F.col("block"), F.lit(0)), F.coalesce(F.col("pages") * (1 - F.col("block")), F.lit(0))
    counts = held.groupBy("token").agg(F.sum(b).alias("b"), F.sum(a).alias("a"), F.count(F.lit(1)).alias("n"))
    taught = F.col("b") + F.col("a") > 0
    counts, t = measured(counts, "url-counts", F.sum("b").alias("b"), F.sum("a").alias("a"), F.count_if(taught).alias("v"), F.sum("n").alias("tokens"))
    t = {name: value or 0 for name, value in t.items()}
    docs = urls.select(F.col("n").alias("pages"), block).agg(F.coalesce(F.sum(b), F.lit(0)).alias("b"), F.coalesce(F.sum(a), F.lit(0)).alias("a")).first()
    prior = math.log((docs["b"] + 1) / (docs["a"] + 1))
    weight = F.log((F.col("b") + 1) / (t["b"] + t["v"] + 1)) - F.log((F.col("a") + 1) / (t["a"] + t["v"] + 1))
    weights = counts.where(taught).select("token", "n", weight.alias("w"))
    scores = lookup(held.select("k", "token"), weights, "token", "n", t["tokens"]).groupBy("k").agg(F.sum("w").alias("s"))
    scores = urls.select("k", F.col("n")).join(scores, "k", "left").select("k", "n", (F.coalesce("s", F.lit(0.0)) + prior).alias("score"))
    judged = lookup(rows, scores, "k", "n", seen["pages"] or 0)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when((F.col("score") > 0) & F.lit(docs["b"] > 0 and docs["a"] > 0), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "score")
