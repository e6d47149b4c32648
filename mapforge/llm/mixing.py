"""Mixing sources to target weights: exact block quotas, dealt to shards by a splitting tree.

A document is cut into blocks of ``block_words`` words. Each source's blocks are put in a hashed
permutation; its quota is the number of blocks (repeats counted) whose words come nearest its target.
The quotas of all sources, an urn of coloured balls, are split in halves of exact size again and
again by multivariate hypergeometric draws until each leaf is one output shard. A leaf's quota of a
source is a range of positions in that source's permutation, and what lies in no leaf is not drawn: what the mix
takes is what the leaves draw. Shards are disjoint and together take the quota exactly. Inside a shard
rows are ordered by another hash: a local shuffle. The levels of the tree are dealt over tasks by node,
and positions meet their leaf by an equi-join on stretches of positions, so neither sources nor shards
are gathered in a row of their own beyond one node's urn (one number a source).

Only DataFrame functions; every draw is a function of the seed, so reruns agree.

Defined results: a null text has size 0; null sources form one source, last in order; a source of
size 0 has target 0; rows equal in doc_id, source and text are told apart by a running number; ties of the
hash go by doc_id, then text; very long texts are many blocks, dealt like others; no rows give no rows; other
columns are ignored (mixed_documents keeps them).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .runtime import let, lookup, measured, ranked, with_text, written

WORD = r"[^\x20\x09-\x0D]+"
KEY = ["doc_id", "source", "size", "text_hash"]


@dataclass(frozen=True)
class Mix:
    """documents: one row per document row; blocks: one row per taken copy of a block, with its shard."""

    documents: DataFrame
    blocks: DataFrame


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """(sid, source, source_size, target, blocks) from (source, source_size, blocks), one row per source.

    Weights repeat over the sources by code point, null last. Filling by weight until a cap is met and
    sharing the excess again ends where min(weight * level, cap) adds up to the whole; the level is
    found from the sources in the order in which they reach their caps.
    """
    everything = Window.partitionBy()
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("sid", (F.row_number().over(by_name) - 1).cast("long"))
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("sid") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("fills_at", F.col("cap") / F.col("w"))
    by_cap = Window.partitionBy().orderBy("fills_at", "sid").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "left": F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(by_cap), F.lit(0.0)),
        "open": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(by_cap), F.lit(0.0)),
    })
    s = s.withColumn("level", F.col("left") / F.col("open"))
    level = F.min(F.when(F.col("fills_at") >= F.col("level"), F.struct("fills_at", "sid", "level"))).over(everything)["level"]
    s = s.withColumn("target", F.coalesce(F.least("cap", F.col("w") * level), F.col("cap")))
    return s.select("sid", "source", "source_size", "target", "blocks")


def hypergeometric(population: Column, marked: Column, draws: Column, u: Column) -> Column:
    """An exact draw of how many of ``draws`` balls are marked, by inversion from the mode; u in [0, 1).

    Probabilities relative to the mode follow from ratios of neighbours; beyond ten standard
    deviations they are below what a double resolves.
    """
    p = F.struct(
        population.cast("double").alias("balls"), marked.cast("double").alias("marked"), draws.cast("double").alias("draws"), u.alias("u")
    )

    def from_bounds(a: Column) -> Column:
        N, K, n = a["balls"], a["marked"], a["draws"]
        lo, hi = F.greatest(F.lit(0.0), n - (N - K)), F.least(n, K)
        mode = F.least(hi, F.greatest(lo, F.floor((n + 1) * (K + 1) / (N + 2)).cast("double")))
        sd = F.sqrt(F.greatest(F.lit(0.0), n * (K / F.greatest(N, F.lit(1.0))) * (1 - K / F.greatest(N, F.lit(1.0))) * (N - n) / F.greatest(N - 1, F.lit(1.0))))
        span = F.ceil(sd * 10).cast("double") + 10
        return F.struct(N.alias("balls"), K.alias("marked"), n.alias("draws"), a["u"].alias("u"), mode.alias("mode"), F.greatest(lo, mode - span).alias("a"), F.least(hi, mode + span).alias("b"))

    def drawn(q: Column) -> Column:
        N, K, n, mode = q["balls"], q["marked"], q["draws"], q["mode"]
        rest = N - K - n
        none = F.array().cast("array<bigint>")
        up = F.when(q["b"] > mode, F.sequence(mode.cast("long"), (q["b"] - 1).cast("long"))).otherwise(none)
        down = F.when(q["a"] < mode, F.sequence(mode.cast("long"), (q["a"] + 1).cast("long"), F.lit(-1).cast("long"))).otherwise(none)
        rise = lambda x: (K - x) * (n - x) / ((x + 1) * (rest + x + 1))
        fall = lambda x: x * (rest + x) / ((K - x + 1) * (n - x + 1))
        one = F.lit(1.0)

        def total(steps: Column, ratio) -> Column:
            start = F.struct(one.alias("w"), F.lit(0.0).alias("s"))
            return F.aggregate(steps, start, lambda t, x: F.struct((t["w"] * ratio(x.cast("double"))).alias("w"), (t["s"] + t["w"] * ratio(x.cast("double"))).alias("s")), lambda t: t["s"])

        def walk(steps: Column, ratio, start: Column, move: int) -> Column:
            def step(t: Column, x: Column) -> Column:
                w = t["w"] * ratio(x.cast("double"))
                return F.struct(w.alias("w"), (t["left"] - w).alias("left"), F.when(t["at"].isNull() & (t["left"] < w), x.cast("double") + move).otherwise(t["at"]).alias("at"))

            return F.aggregate(steps, start, step)

        def find(r: Column) -> Column:
            first = F.struct(one.alias("w"), (r - 1).alias("left"), F.when(r < 1, mode).alias("at"))
            return let(walk(up, rise, first, 1), lambda t: F.coalesce(walk(down, fall, F.struct(one.alias("w"), t["left"].alias("left"), t["at"].alias("at")), -1)["at"], mode))

        return find(q["u"] * (one + total(up, rise) + total(down, fall))).cast("long")

    return let(let(p, from_bounds), drawn)


def split(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, sid, quota) from (sid, quota): the splitting tree. Shard sizes differ by one block at most."""
    urn = quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct("sid", F.col("quota").cast("long").alias("quota")))).alias("balls"), F.sum("quota").alias("all"))
    nodes = urn.where("all > 0").select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "balls", "all")
    for level in range(max(0, math.ceil(math.log2(shards)))):
        if level in (6, 12):
            nodes = nodes.repartition("lo")
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        upto = lambda k: F.floor(k * F.col("all") / shards)
        nodes = nodes.withColumn("mid", mid).withColumn("draws", (upto(F.col("mid")) - upto(F.col("lo"))).cast("long"))

        def draw(state: Column, ball: Column) -> Column:
            h = F.xxhash64(F.lit(seed), F.col("lo"), F.col("hi"), ball["sid"])
            got = hypergeometric(state["population"], ball["quota"], state["draws"], F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53)))
            return F.transform(F.array(got), lambda x: F.struct(
                (state["population"] - ball["quota"]).alias("population"), (state["draws"] - x).alias("draws"),
                F.concat(state["out"], F.array(F.struct(ball["sid"].alias("sid"), x.alias("quota")))).alias("out"),
            ))[0]

        total = F.aggregate("balls", F.lit(0).cast("long"), lambda t, b: t + b["quota"])
        start = F.struct(total.alias("population"), F.col("draws"), F.array().cast("array<struct<sid:bigint,quota:bigint>>").alias("out"))
        left = F.aggregate("balls", start, draw, lambda t: t["out"])
        nodes = nodes.withColumn("left", F.when(F.col("hi") - F.col("lo") > 1, left))
        right = F.zip_with("balls", "left", lambda b, l: F.struct(b["sid"].alias("sid"), (b["quota"] - l["quota"]).alias("quota")))
        children = F.when(
            F.col("hi") - F.col("lo") > 1,
            F.array(F.struct("lo", F.col("mid").alias("hi"), F.col("left").alias("balls")), F.struct(F.col("mid").alias("lo"), "hi", right.alias("balls"))),
        ).otherwise(F.array(F.struct("lo", "hi", "balls")))
        nodes = nodes.select("all", F.explode(children).alias("c")).select("c.lo", "c.hi", "c.balls", "all")
    return nodes.select(F.col("lo").alias("shard"), F.inline("balls"))


def mix(
    documents: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2,
    block_words: int = 256, blocks_per_shard: int = 16384, seed: int = 20_24,
) -> Mix:
    """Mix documents (doc_id, text, source) so that sources come to their targets.

    Mix.documents: doc_id, source, size, text_hash, rep, sid, source_size, target.
    Mix.blocks: sid, the document's key, block, words, copy, position (in the source's draw), shard, shuffle_key.
    """
    text = F.coalesce("text", F.lit(""))
    rows = (
        documents.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64("text").alias("text_hash"))
        .groupBy(*KEY).agg(F.count(F.lit(1)).alias("m")).select(*KEY, F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("rep"))
    )
    rows = written(rows, "mix-rows")
    n_blocks = F.ceil(F.col("size") / block_words)
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(n_blocks).alias("blocks"))
    sources = written(targets(sizes, weights, share, most), "mix-targets")
    docs = rows.alias("r").join(sources.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))).select("r.*", "s.sid", "s.source_size", "s.target", F.col("s.blocks").alias("source_blocks"))

    whole = F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))
    blocks = (
        docs.where("size > 0").withColumn("whole", whole.cast("long"))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1)))
        .withColumn("words", F.least(F.lit(block_words).cast("long"), F.col("size") - F.col("block") * block_words))
        .withColumn("more", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("h", F.xxhash64(F.lit(seed), *KEY, "rep", "block"))
        .select("sid", *KEY, "rep", "block", "words", "whole", "more", "source_blocks", "h")
    )
    placed = ranked(blocks, ["sid"], "h", ["doc_id", "text_hash", "rep", "block"], weight="words")
    extra = (F.col("before") + F.col("words") / 2 < F.col("more")).alias("extra")
    placed = written(placed.select("sid", *KEY, "rep", "block", "words", "whole", "source_blocks", "rank", extra), "mix-placed")
    quota = F.max("whole") * F.max("source_blocks") + F.count_if("extra")
    quotas, seen = measured(placed.groupBy("sid").agg(quota.alias("quota"), F.max("source_blocks").alias("blocks")), "mix-quotas", F.sum("quota").alias("quota"), F.sum("blocks").alias("blocks"))
    shards = 1 << max(1, math.ceil(math.log2(max(1, (seen["quota"] or 0) / blocks_per_shard))))
    per_source = Window.partitionBy("sid").orderBy("shard")
    leaves = split(quotas, shards, seed).where("quota > 0").withColumn("end", F.sum("quota").over(per_source))
    leaves = leaves.select("sid", "shard", (F.col("end") - F.col("quota")).alias("start"), "end")
    # A source's positions in stretches as long as its leaves are on average, so few leaves meet in one.
    stretch = F.greatest(F.lit(1).cast("long"), F.floor(F.col("quota") / shards)).alias("stretch")
    leaves = leaves.join(quotas.select("sid", stretch), "sid").select("sid", "shard", "start", "end", F.explode(F.sequence(F.floor(F.col("start") / F.col("stretch")), F.floor((F.col("end") - 1) / F.col("stretch")))).alias("at"))
    leaves = written(leaves, "mix-leaves")
    drawn = lookup(placed, quotas.select("sid", "quota", stretch, "blocks"), "sid", "blocks", seen["blocks"] or 0).where("rank < quota")
    copies = F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - 1 - F.col("rank")) / F.col("source_blocks")))
    drawn = drawn.withColumn("copy", F.explode(copies)).withColumn("position", F.col("copy") * F.col("source_blocks") + F.col("rank"))
    drawn = drawn.withColumn("at", F.floor(F.col("position") / F.col("stretch"))).join(leaves, ["sid", "at"]).where("start <= position AND position < end")
    drawn = drawn.select("sid", *KEY, "rep", "block", "words", "copy", "position", "shard", F.xxhash64(F.lit(seed + 1), "position", "sid").alias("shuffle_key"))
    return Mix(docs.select(*KEY, "rep", "sid", "source_size", "target"), drawn)


def taken_words(mixed: Mix) -> DataFrame:
    """doc_id, size, source_size, target, the words that the shards draw of each document row, and these shards (numbers, comma-joined)."""
    key = [*KEY, "rep", "sid"]
    none = mixed.documents.select(*key, "source_size", "target", F.lit(0).cast("long").alias("words"), F.lit(None).cast("int").alias("shard"))
    some = mixed.blocks.select(*key, F.lit(None).cast("long").alias("source_size"), F.lit(None).cast("double").alias("target"), "words", "shard")
    sums = [F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.sum("words").alias("taken"), F.collect_set("shard").alias("shards")]
    return none.unionByName(some).groupBy(*key).agg(*sums).select("doc_id", "size", "source_size", "target", "taken", F.array_join(F.sort_array("shards"), ",").alias("shards"))


def mixed_documents(documents: DataFrame, block_words: int = 256, **options) -> DataFrame:
    """documents as the mix takes them: a row for each copy that it takes of a document, those with none go.

    A copy of which all blocks are taken keeps its text; otherwise the text is that of its taken blocks, in their
    order, with the white space between their words as it was, and n_chars is counted anew. Rows come shard by
    shard (that of a copy's first block), in each shard in the order of the local shuffle.
    """
    mixed = mix(documents, block_words=block_words, **options)
    picks = mixed.blocks.groupBy(*KEY, "rep", "copy").agg(F.sort_array(F.collect_list(F.struct("block", "shard", "shuffle_key"))).alias("picks"))
    picks = picks.groupBy(*KEY, "rep").agg(F.collect_list("picks").alias("copies")).groupBy(*KEY).agg(F.collect_list("copies").alias("rows")).withColumnsRenamed({k: f"k_{k}" for k in KEY})
    text = F.coalesce("text", F.lit(""))
    others = F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != "text"]).alias("row")
    rows = documents.select(others, "text", "doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("k_doc_id")) & F.col("source").eqNullSafe(F.col("k_source")) & (F.col("size") == F.col("k_size")) & (F.col("text_hash") == F.col("k_text_hash"))
    met = rows.join(picks, same)
    # Rows equal in all of the key: each takes the blocks of another of them.
    number = Window.partitionBy("k_doc_id", "k_source", "k_size", "k_text_hash").orderBy(F.lit(1))
    one = met.where(F.size("rows") == 1).withColumn("mine", F.col("rows")[0])
    several = met.where(F.size("rows") > 1).withColumn("number", F.row_number().over(number)).where(F.col("number") <= F.size("rows"))
    out = one.unionByName(several.withColumn("mine", F.get("rows", F.col("number") - 1)).drop("number"))
    out = out.select("row", "text", "size", F.explode("mine").alias("mine"))
    whole = F.size("mine") == F.ceil(F.col("size") / block_words)
    # Each word with the white space before it: joined again, they are the text.
    cut = let(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), lambda w: F.array_join(F.transform("mine", lambda p: F.array_join(F.slice(w, (p["block"] * block_words + 1).cast("int"), F.lit(block_words)), "")), ""))
    cut = F.regexp_replace(cut, r"^[\x20\x09-\x0D]+", "")
    out = out.select("row", F.when(whole, F.col("text")).otherwise(cut).alias("text"), F.col("mine")[0]["shard"].alias("shard"), F.col("mine")[0]["shuffle_key"].alias("shuffle_key"))
    # A shard is up to four files by the upper bits of the shuffle's key, so that no task holds a whole one.
    quarter = F.call_function("shiftrightunsigned", "shuffle_key", F.lit(62))
    return with_text(out.repartition("shard", quarter).sortWithinPartitions("shard", "shuffle_key"), documents.columns)
