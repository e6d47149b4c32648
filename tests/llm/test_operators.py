"""Operators against brute force on small tables, with the odd rows that each must bear."""

import base64
import binascii
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from mapforge.llm import fingerprint, jaccard, langid, mixing, packing, repeats, runtime, textkit, urls, vectors, warc
from mapforge.llm.queries import QUERIES, RULES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = ["", None, " \t\n", "one", "Two words", "three words here", "é ñ 日本 😀 x", "A\u00a0b\u2003c d", "x" * 30000, "a b c\x0bd\x0ce"]


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = list(BASE)
    for _ in range(n):
        texts.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 200))))
    for i in range(12, 40):  # copies, near copies, a shared passage
        words = texts[i].split()
        texts += [texts[i].upper(), " ".join(words[:-1] + ["changed"]), " ".join(words[:3] + texts[11].split()[:45] + words[3:])]
    texts += [texts[20]] * 5
    return list(enumerate(texts))


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# -- 2 WARC
def test_archives_round_trip(spark, tmp_path):
    pages = [(1, "http://a/\\r", "x"), (2, None, "x"), (3, "u\nv", None), (4, "", ""), (None, "n", "x"), (5, "b", "é😀" * 50000), (5, "b", "é😀" * 50000), (7, "c", "once")]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, payload int")
    index = warc.write_archives(df, f"file://{tmp_path}/warc")
    got = sorted(rows_of(warc.read_records(index)), key=lambda r: (r["page_id"] is None, r["page_id"] or 0))
    last = {}
    for i, _, h in pages:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = sorted(pages, key=lambda p: (p[0] is None, p[0] or 0))
    for r, (i, u, h) in zip(got, want, strict=True):
        data = (h or "").encode()
        revisit = i != last[h or ""]
        assert (r["page_id"], r["url"], r["payload_bytes"], r["record_type"], r["refers_to"]) == (i, u, len(data), "revisit" if revisit else "response", last[h or ""] if revisit else None)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r["payload"] == (None if revisit else data)
    for r in index.select("archive").distinct().collect():
        path = r["archive"].removeprefix("file://")
        with open(path, "rb") as f:
            assert sorted(warc.members(f.read())) == sorted((x["offset"], x["length"]) for x in index.where(index["archive"] == r["archive"]).collect())
    assert warc.write_archives(df.limit(0), f"file://{tmp_path}/none").count() == 0


def test_archives_by_another_parser(spark, tmp_path):
    """Records as a reader that knows only the standard sees them: gzip members, named fields, an HTTP message in the block."""
    import gzip
    import http.client
    import io
    import uuid

    pages = [(1, "http://a/x", "<p>é</p>"), (2, "http://a/y z", "<p>é</p>"), (3, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    index = warc.write_archives(df, f"file://{tmp_path}/warc", date="2026-01-31T00:00:00Z").collect()
    seen, kinds = {}, []
    for path in {r["archive"].removeprefix("file://") for r in index}:
        f = io.BytesIO(gzip.open(path).read())
        while line := f.readline():
            assert line == b"WARC/1.1\r\n"
            fields = http.client.parse_headers(f)
            block = f.read(int(fields["Content-Length"]))
            assert f.read(4) == b"\r\n\r\n" and fields["WARC-Date"] == "2026-01-31T00:00:00Z"
            uuid.UUID(fields["WARC-Record-ID"].strip("<>"))
            kinds.append(fields["WARC-Type"])
            if fields["WARC-Type"] != "warcinfo":
                head = io.BytesIO(block)
                assert head.readline() == b"HTTP/1.1 200 OK\r\n"
                length = int(http.client.parse_headers(head)["Content-Length"])
                seen[fields["WARC-Record-ID"]] = fields, head.read(), length
    assert kinds[0] == "warcinfo" and sorted(kinds[-3:]) == ["response", "response", "revisit"]
    for fields, payload, length in seen.values():
        if fields["WARC-Type"] == "revisit":
            assert payload == b"" and fields["WARC-Target-URI"] == "http://a/x"
            fields, payload, _ = seen[fields["WARC-Refers-To"]]
            assert fields["WARC-Target-URI"] == "http://a/y%20z"
        else:
            assert len(payload) == length
        assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- 3 language
def profiles_by_hand(texts):
    """Language to its ranked n-grams of one to three letters, counted character by character."""
    counts = collections.defaultdict(collections.Counter)
    for text, lang in texts:
        if text is not None and lang is not None:
            counts[lang].update(grams_by_hand(text))
    return {k: ranks_by_hand(c) for k, c in counts.items()}


def grams_by_hand(text):
    letters = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text)
    padded = " " + " ".join(letters.split()) + " "
    found = collections.Counter(c for c in padded if c != " ")
    for n in (2, 3):
        found.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    return collections.Counter({g: c for g, c in found.items() if g.strip() and (len(g) < 3 or g[1] != " ")})


def ranks_by_hand(counts, size=langid.SIZE):
    number = lambda g: sum((1 if c == " " else ord(c)) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], number(x[0])))][:size]


def test_language_by_hand(spark, docs_of):
    """Profile, out-of-place distance and choice against brute force, on documents of four languages."""
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    rows += [(-1, "Ünïcode ÄÖ x", None), (-2, "a", "de"), (-3, "ab ab, ab!", None), (-4, "1 2 3", None)]
    want = profiles_by_hand([(t, lang) for _, t, lang in rows])
    learned = langid.profiles(docs_of(rows).select("text", "lang"))
    assert {k: len(v) for k, v in learned.items()} == {k: len(v) for k, v in want.items()}
    got = {r["doc_id"]: r for r in langid.predict(docs_of(rows), learned).collect()}
    for doc_id, text, _ in rows:
        own = ranks_by_hand(grams_by_hand(text or ""))
        if not own:
            assert (got[doc_id]["lang_pred"], got[doc_id]["score"]) == ("und", 0.0)
            continue
        distance = {k: sum(abs(p.index(g) - i) if g in p else langid.SIZE for i, g in enumerate(own)) for k, p in want.items()}
        best = min(sorted(distance, key=lambda s: s.encode()), key=distance.get)
        assert got[doc_id]["lang_pred"] == best, text
        assert got[doc_id]["score"] == pytest.approx(1 - distance[best] / (langid.SIZE * len(own)))


def test_language_profiles(spark, docs_of):
    en, de = "the quick brown fox jumps over the lazy dog and the cat " * 5, "der schnelle braune fuchs springt über den faulen hund und die katze " * 5
    learned = langid.profiles(docs_of([(1, en, "en"), (2, de, "de"), (3, None, "fr"), (4, "x", None)]).select("text", "lang"))
    assert list(learned) == ["de", "en"]
    df = docs_of([(1, "the dog"), (2, "der hund und die"), (3, None), (4, "12 34 !"), (5, ""), (6, en * 3000)], clash=True).withColumn("score", runtime.F.lit(7))
    got = {r["doc_id"]: (r["lang_pred"], r[-1]) for r in langid.predict(df, learned).collect()}
    assert [got[i][0] for i in range(1, 7)] == ["en", "de", "und", "und", "und", "en"] and all(0 <= s <= 1 for _, s in got.values())
    assert langid.predict(df, {}).select("lang_pred").distinct().collect()[0][0] == "und"


def test_grams_count_as_by_hand():
    grams, counts = langid._grams("Ab, ab")
    a, b, s = ord("a"), ord("b"), 1
    want = collections.Counter({a: 2, b: 2, s << 21 | a: 2, a << 21 | b: 2, b << 21 | s: 2, s << 42 | a << 21 | b: 2, a << 42 | b << 21 | s: 2})
    got = dict(zip(grams.tolist(), counts.tolist(), strict=True))
    assert all(got[k] == v for k, v in want.items())


def test_held_out_accuracy(spark):
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op3_langid"](spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    right = got.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    for r in got.collect():
        assert r["held_out"] == (binascii.crc32(str(r["doc_id"]).encode()) % 3 == 1)


# -- 4 URLs
def judged_by_hand(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fits, key=len, default=None)


def split_by_hand(piece, counts, total):
    """The best of all splits into words, by their logarithms; ties go to the longer last word."""
    import functools
    import math

    def score(word):
        return math.log(counts[word] / total) if word in counts else math.log(10 / total) - len(word) * math.log(10)

    @functools.cache
    def best(end):
        if not end:
            return 0.0, ()
        return max(((best(at)[0] + score(piece[at:end]), best(at)[1] + (piece[at:end],)) for at in range(end)), key=lambda x: x[0])

    return best(len(piece))


def test_urls(spark):
    """Hosts, paths, rules, words, scores and verdicts against brute force."""
    import math

    seen = ["http://A.Example.com/en/7x?q", "x://example.net/de/8", "x://net/de/8", "x://example.org/es/#t", "nothing", None, "://", "http://badexample.com/en/1", "http://www.freepills.example.com/fr/1", "http://nice.example.com/fr/2", "http://É.com/en/", "http://casino-one.net/x", "http://casino-one.net/x", "http://freecasino.org/es/3", "http://niceexample.net/de/77", "y://qqqqqq" + "a" * 30 + ".info/fr", "y://" + "z" * 300 + ".info/"]
    html = "<p>free pills and nice casino one example</p>"
    df = spark.createDataFrame([(i, u, html * 9, 1) for i, u in enumerate(seen)], "page_id long, url string, html string, score int")
    got = {r["page_id"]: r for r in rows_of(urls.judge(df, RULES))}
    assert len(got) == len(seen)
    counts = {w: 9 * len(seen) for w in ("free", "pills", "and", "nice", "casino", "one", "example")}
    parts = {}
    for u in seen:
        host, path, rule = judged_by_hand(u)
        words = [w for p in re.findall("[a-z]+", host) for w in (split_by_hand(p, counts, sum(counts.values()))[1] if len(p) <= 253 else (p,))]
        parts.setdefault((host, path), [[*words, *("." + x for x in host.split(".") if x), *("/" + ("#" if x[0].isdigit() else x) for x in re.findall("[a-z]+|[0-9]+", path.lower()))], rule, 0])[2] += 1
    taught = {"block": collections.Counter(), "allow": collections.Counter()}
    pages = collections.Counter()
    for tokens, rule, n in parts.values():
        if rule:
            pages[RULES[rule]] += n
            for t in tokens:
                taught[RULES[rule]][t] += n
    vocabulary = set(taught["block"]) | set(taught["allow"])
    of = lambda t, k: math.log((taught[k][t] + 1) / (sum(taught[k].values()) + len(vocabulary) + 1))
    verdicts = set()
    for i, u in enumerate(seen):
        host, path, rule = judged_by_hand(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        score = math.log((pages["block"] + 1) / (pages["allow"] + 1)) + sum(of(t, "block") - of(t, "allow") for t in parts[host, path][0] if t in vocabulary)
        assert got[i]["score"] == pytest.approx(score), u
        assert got[i]["verdict"] == (RULES[rule] if rule else "block" if score > 0 else "allow")
        verdicts |= set() if rule else {got[i]["verdict"]}
    assert verdicts == {"block", "allow"}
    assert urls.judge(df.limit(0), RULES).count() == 0
    assert urls.viterbi("freepills", {"free": 9, "pills": 9, "pill": 5, "s": 1}, 100) == ["free", "pills"]
    rng = random.Random(2)
    for _ in range(200):
        some = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 5))): rng.randrange(1, 50) for _ in range(6)}
        piece = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 12)))
        words = urls.viterbi(piece, some, 300)
        assert "".join(words) == piece and sum(math.log(some[w] / 300) if w in some else math.log(10 / 300) - len(w) * math.log(10) for w in words) == pytest.approx(split_by_hand(piece, some, 300)[0])


# -- 5 mixing
def test_mixing(spark, docs_of):
    rng = random.Random(3)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(0, 900))), "en", rng.choice(["a", "b", "B", None, "é"])) for i in range(150)] + [(5, "same text", "en", "a")] * 3 + [(900, None, "en", "z"), (None, "x y", "en", "a")]
    df = docs_of(rows, clash=True)
    mixed = mixing.mix(df, blocks_per_shard=64)
    got = rows_of(mixing.taken_words(mixed))
    assert len(got) == len(rows) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in free}
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= full
    by_size = {(r["size"], r["source_size"]): r["target"] for r in got}
    taken = collections.Counter()
    for r in got:
        taken[r["source_size"]] += r["taken"]
    for s in names:
        assert taken[sizes[s]] == pytest.approx(target[s], abs=260)
        assert any(t == pytest.approx(target[s]) for (_, n), t in by_size.items() if n == sizes[s])
    assert sorted(map(str, got)) == sorted(map(str, rows_of(mixing.taken_words(mixing.mix(df, blocks_per_shard=64)))))
    shards = mixed.blocks.groupBy("shard").count().collect()
    assert max(r["count"] for r in shards) - min(r["count"] for r in shards) <= 1
    assert mixed.blocks.select("sid", "position").distinct().count() == mixed.blocks.count()
    assert mixing.taken_words(mixing.mix(docs_of([]))).count() == 0


def test_hypergeometric_draws(spark):
    from pyspark.sql import functions as F

    df = spark.range(4000).select(mixing.hypergeometric(F.lit(50), F.lit(20), F.lit(10), (F.col("id") + 0.5) / 4000).alias("x"))
    got = collections.Counter(r["x"] for r in df.collect())
    mean = sum(k * v for k, v in got.items()) / 4000
    assert mean == pytest.approx(4.0, abs=0.02) and sum((k - mean) ** 2 * v for k, v in got.items()) / 4000 == pytest.approx(10 * 0.4 * 0.6 * 40 / 49, rel=0.02)
    edges = spark.range(1).select(*[mixing.hypergeometric(F.lit(a), F.lit(b), F.lit(c), F.lit(0.3)).alias(f"x{i}") for i, (a, b, c) in enumerate([(0, 0, 0), (5, 5, 3), (5, 0, 3), (5, 2, 5)])])
    assert list(edges.first()) == [0, 3, 0, 2]


def test_mixed_documents(spark, docs_of):
    df = docs_of([(i, f"w{i} " * 40, "en", "a" if i % 2 else "b") for i in range(40)] + [(3, "w3 " * 40, "en", "a")], clash=True)
    out = mixing.mixed_documents(df, block_words=16)
    assert out.columns == df.columns
    taken = sum(r["taken"] for r in rows_of(mixing.taken_words(mixing.mix(df, block_words=16))))
    assert sum(len(r["text"].split()) for r in out.collect()) == taken


# -- 6 fingerprints
def test_fingerprints(spark, docs_of):
    texts = ["a\nb\nc", "c\na\nb", "", None, "é😀x" * 100, "line one\n" * 50, "\n".join(f"line {i}" for i in range(400)), "a\nb\nc"]
    rows = [(10 - i, t) for i, t in enumerate(texts)] + [(2, "again"), (2, "again"), (None, "nothing")]
    got = rows_of(fingerprint.fingerprints(docs_of(rows, clash=True)))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want = []
    for i, (d, t) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        cut = len(t) // 4
        want.append((d, len(t), hashlib.sha256((t[: len(t) - cut] + after[:cut]).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["n_chars"], r["edited_sha256"])) for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[10]["fingerprint"] == by[9]["fingerprint"] == by[3]["fingerprint"] != by[6]["fingerprint"]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert fingerprint.fingerprints(docs_of([])).count() == 0
    one = rows_of(fingerprint.fingerprints(docs_of([(1, "abcdefgh")])))
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and one[0]["near_next"] == 1.0


def test_fingerprints_are_homomorphic(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a\nb\nc", "b", "a\nc")], "t string, p string, rest string")
    for c in ("t", "p", "rest"):
        df = df.withColumn(c, fingerprint.lanes(fingerprint.paragraphs(F.col(c)))).cache()
    r = df.select("t", "rest", fingerprint.plus(F.col("rest"), F.col("p")).alias("put"), fingerprint.minus(F.col("t"), F.col("p")).alias("out"), fingerprint.from_hex(fingerprint.to_hex(F.col("t"))).alias("same")).first()
    assert r["t"] == r["put"] == r["same"] and r["out"] == r["rest"]


def test_lanes_by_hand(spark):
    """Lanes and likeness from SHA-256, Spark's 64-bit hash and plain sums."""
    import math

    from pyspark.sql import functions as F

    texts = ["One line. Two\nthree", "One line. Two\nthree and more jazz to hear", "日本。語\n\nx 1 y", ""]
    pieces = [["One line. ", "Two", "three"], ["One line. ", "Two", "three and more jazz ", "to hear"], ["日本。", "語", "x ", "1 ", "y"], []]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = [r["l"] for r in df.select("id", fingerprint.lanes(fingerprint.paragraphs(F.col("t"))).alias("l")).orderBy("id").collect()]
    distinct = sorted({p for q in pieces for p in q})
    digests = spark.createDataFrame([(p, hashlib.sha256(p.encode()).hexdigest()) for p in distinct], "p string, d string")
    hashes = {r["p"]: (r["d"], r["h"], r["more"]) for r in digests.select("p", "d", F.xxhash64("p").alias("h"), F.array(*[F.xxhash64("d", F.lit(i)) for i in range(8, 64)]).alias("more")).collect()}
    want = []
    for found in pieces:
        lanes = [0] * fingerprint.LANES
        for p in found:
            digest, h, more = hashes[p]
            vector = [int(digest[i * 8 : i * 8 + 8], 16) for i in range(8)] + [x % (1 << 32) for x in more] + [1 if h >> i & 1 else -1 for i in range(64)]
            lanes = [(a + b) % (1 << 32) for a, b in zip(lanes, vector, strict=True)]
        want.append(lanes)
    assert got == want and len(got[0]) == 128
    signed = [[x - (1 << 32) if x >> 31 else x for x in lanes[64:]] for lanes in want]
    pairs = spark.createDataFrame([(i, j, want[i], want[j]) for i in range(4) for j in range(4)], "i int, j int, a array<long>, b array<long>")
    for r in pairs.select("i", "j", fingerprint.likeness(F.col("a"), F.col("b")).alias("x")).collect():
        a, b = signed[r["i"]], signed[r["j"]]
        norm = math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))
        cosine = sum(x * y for x, y in zip(a, b, strict=True)) / norm if norm else 0.0
        assert r["x"] == pytest.approx(1.0 if r["i"] == r["j"] else max(0.0, min(0.99, cosine)))


def test_next_document_on_a_whole_table(spark):
    got = sorted(rows_of(QUERIES["op6_fingerprints"](spark, "/root/testdata/sf0.001")), key=lambda r: r["doc_id"])
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect())
    assert sum(r["near_edited"] for r in got) > 0.5 * len(got) > 4 * sum(r["near_next"] for r in got)
    for i, (d, t) in enumerate(docs):
        cut = len(t) // 4
        assert got[i]["doc_id"] == d and got[i]["edited_sha256"] == hashlib.sha256((t[: len(t) - cut] + docs[(i + 1) % len(docs)][1][:cut]).encode()).hexdigest()


# -- 7 vectors
def test_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 16))
    for i in range(100, 300):  # groups around others, at all distances about the threshold
        x[i] = x[i % 20] / np.linalg.norm(x[i % 20]) + rng.standard_normal(16) * rng.choice([0.01, 0.03, 0.06, 0.1])
    rows = [(i, [float(np.float32(v)) for v in r], int(i % 20) % 3) for i, r in enumerate(x)]
    rows += [(500, rows[3][1], rows[3][2]), (501, [2 * v for v in rows[3][1]], rows[3][2]), (502, None, 1), (503, [0.0] * 16, 1), (504, [float("nan")] * 16, 1), (505, [None] * 16, 1), (506, rows[3][1], None), (507, rows[3][1][:8], rows[3][2]), (508, [], 1), (None, rows[3][1], rows[3][2]), (500, rows[3][1], rows[3][2])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, links int")
    good = [i for i, r in enumerate(rows) if r[0] is not None and r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    near = collections.defaultdict(set)
    for a in good:
        for b in good:
            u, v = np.array(rows[a][1]), np.array(rows[b][1])
            if a != b and rows[a][2] == rows[b][2] and len(u) == len(v) and u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.98:
                near[a].add(b)
    for block in (1024, 8):
        got = rows_of(vectors.near_duplicates(df, block=block, miss=1e-6))
        links = sorted((r["vec_id"], r["n_links"]) for r in got if r["vec_id"] is not None)
        assert links == sorted((rows[i][0], len(near[i])) for i in range(len(rows)) if rows[i][0] is not None)
        for r in got:
            assert r["vec_id"] is None or r["kept"] == (r["component_id"] == r["vec_id"])
        part = {r["vec_id"]: r["component_id"] for r in got}
        for a in near:
            for b in near[a]:
                assert part[rows[a][0]] == part[rows[b][0]] <= rows[a][0]
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_vectors_recall_as_registered(spark):
    """Planted pairs at cosines from 0.98 to 1, among unrelated vectors, with the registered settings."""
    rng = np.random.default_rng(11)
    d, n = 64, 1500
    x = rng.standard_normal((n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    other = rng.standard_normal((n, d))
    other -= (other * x).sum(axis=1, keepdims=True) * x
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = np.linspace(0.9802, 1.0, n)
    y = cosine[:, None] * x + np.sqrt(1 - cosine**2)[:, None] * other
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([x, y]))] + [(2 * n + i, v.tolist(), 0) for i, v in enumerate(rng.standard_normal((1000, d)))]
    part = {r["vec_id"]: r for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    found = sum(part[i]["component_id"] == part[n + i]["component_id"] for i in range(n)) / n
    assert found >= 0.99
    assert all(part[2 * n + i]["n_links"] == 0 for i in range(1000))


# -- 8 n-gram Jaccard
def linked_by_hand(rows, k, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)]) if w else frozenset())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(rows[i][0], len(sets[i]), rows[find(i)][0]) for i in range(len(rows))]


@pytest.mark.parametrize(("k", "percent", "long", "block"), [(3, 90, 64, 512), (5, 80, 64, 512), (2, 50, 3, 2)])
def test_jaccard(spark, docs_of, monkeypatch, k, percent, long, block):
    monkeypatch.setattr(jaccard, "LONG", long)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = corpus()
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows_of(jaccard.near_copies(docs_of(rows, clash=True), k=k, percent=percent))]
    assert sorted(got) == sorted(linked_by_hand(rows, k, percent))


def test_jaccard_edges(spark, docs_of):
    assert jaccard.near_copies(docs_of([])).count() == 0
    got = sorted(rows_of(jaccard.near_copies(docs_of([(None, "a b c"), (2, "A b c"), (2, "A b c"), (3, None)]))), key=str)
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in got) == [("2", 2), ("2", 2), ("3", 3), ("None", 2)]
    kept = jaccard.deduplicated(docs_of([(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, None), (3, None), (4, "")], clash=True))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]


def test_jaccard_prefixes_are_rare(spark, docs_of):
    """Among millions of shingles, those of four documents do not pass for rare: each document has enough of its own."""
    rng = np.random.default_rng(8)
    own, passages = rng.integers(0, 1 << 40, (1000, 2100)), rng.integers(0, 1 << 40, (250, 900))
    rows = [(i, " ".join(f"{x:x}" for x in np.concatenate([own[i], passages[i // 4]]).tolist())) for i in range(1000)]
    docs = docs_of(rows).repartition(4).select("doc_id", "text")
    with runtime.temporary(spark):
        head, total = jaccard.heads(docs, 3, 90, jaccard.sketch(docs, 3))
        often = head.selectExpr("explode(prefix) AS shingle").groupBy("shingle").count()
        assert total == 1000
        assert often.where("count > 1").count() == 0


def test_deduplicated_tells_rows_apart(spark, docs_of):
    """Null and repeated ids with unequal texts: one row of each component, all empty ones of null ids."""
    a, b, c, d = ("a1 a2 a3 a4 a5 a6", "b1 b2 b3 b4 b5 b6", "c1 c2 c3 c4 c5 c6", "d1 d2 d3 d4 d5 d6")
    rows = [(1, a), (None, a), (None, b), (None, b), (None, c), (2, a), (2, c), (3, d), (3, "e"), (3, "e"), (4, None), (4, ""), (None, None), (None, None), (None, "")]
    for batch in (rows, rows[::-1]):
        kept = jaccard.deduplicated(docs_of(batch, clash=True)).collect()
        assert sorted([(r["doc_id"], r["text"]) for r in kept], key=str) == sorted([(1, a), (None, b), (2, c), (3, d), (3, "e"), (4, None), (4, ""), (None, None), (None, None), (None, "")], key=str)
        assert {r["words"] for r in kept} == {5}
    # A third of all ids null, some repeated: as many rows stay as there are components, the least of each.
    rows = [(None if i % 3 == 0 else i // 2, t) for i, t in corpus(3)]
    texts = dict(enumerate(t for _, t in rows))
    least = {i: root for i, _, root in linked_by_hand(list(texts.items()), 5, 80)}
    groups = collections.defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        groups[least[i]].append((doc_id, text))
    empty = lambda t: not WORD.findall(t or "")
    kept = collections.Counter((r["doc_id"], r["text"]) for r in jaccard.deduplicated(docs_of(rows)).collect())
    assert all(kept[r] for r in rows if empty(r[1]))
    for group in (g for g in groups.values() if not empty(g[0][1])):
        left = [r for r in set(group) if kept[r]]
        assert len(left) == kept[left[0]] == 1
        assert left[0][0] == min((r[0] for r in group if r[0] is not None), default=None)
    assert jaccard.deduplicated(docs_of([])).count() == 0


# -- 9 repeats
@pytest.mark.parametrize("window", [35, 9])
def test_repeats(spark, docs_of, window):
    rows = corpus(2) + [(1000, "p q " * 60), (1001, "solo " * 34)]
    words = {d: WORD.findall(t or "") for d, t in rows}
    seen = collections.Counter(tuple(w[i : i + window]) for w in words.values() for i in range(len(w) - window + 1))
    want = []
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        want.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()))
    got = [(r["doc_id"], r["n_words"], r["n_removed"], bytes(r["kept"])) for r in rows_of(repeats.without_repeats(docs_of(rows, clash=True), window))]
    assert sorted(got) == sorted(want)


def test_repeats_edges(spark, docs_of):
    assert repeats.without_repeats(docs_of([])).count() == 0
    text = " ".join(f"v{i}" for i in range(50))
    got = rows_of(repeats.without_repeats(docs_of([(1, text), (1, text), (None, text + " more"), (2, None)])))
    assert sorted((str(r["doc_id"]), r["n_removed"], bytes(r["kept"])) for r in got) == [("1", 50, b""), ("1", 50, b""), ("2", 0, b""), ("None", 50, b"more")]


def test_words_of_texts():
    import pyarrow as pa

    texts = ["", "a", " b ", None, "c\x0bd", "é x", "y"]
    for array in (pa.array(texts), pa.array(["skip", *texts])[1:]):
        w = textkit.Words(array)
        got = [[bytes(w.data[w.starts[j] : w.ends[j]]).decode() for j in range(w.first[i], w.first[i + 1])] for i in range(len(texts))]
        assert got == [WORD.findall(t or "") for t in texts]
        h = w.hashes()
        assert len(set(h.tolist())) == len(h)


# -- 10 packing
def test_packing(spark, docs_of):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = corpus(4) + [(2000, "word é " * 9000), (2001, "<|endoftext|> a"), (2002, "日本 text \u00a0 x"), (2003, "x  y " * 300000)]
    got = rows_of(packing.pack(docs_of(rows, clash=True)))
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        pieces = sorted(by[d], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces))) and (len(pieces) == 1) == (len(ids) <= 2048)
        at = 0
        for i, r in enumerate(pieces):
            assert r["start"] == at and (i == 0 or r["length"] == 2048)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    full(got, 2048)
    assert packing.pack(docs_of([])).count() == 0


def full(rows, capacity):
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_best_fit_is_that_of_single_pieces():
    rng = random.Random(6)
    for _ in range(30):
        lengths = [rng.randrange(1, 65) for _ in range(rng.randrange(0, 400))]
        gaps = []
        for n in sorted(lengths, reverse=True):
            fits = [g for g in gaps if g >= n]
            if fits:
                gaps.remove(min(fits))
            gaps.append((min(fits) if fits else 64) - n)
        rows = [{"sequence_id": p.sequence + i // p.each, "offset": p.offset + i % p.each * p.length, "length": p.length} for p in packing.best_fit(collections.Counter(lengths), 64) for i in range(p.end - p.first)]
        assert sorted(r["length"] for r in rows) == sorted(lengths)
        assert full(rows, 64) == len(gaps)


# -- shared
def test_components_and_ranks(spark):
    from pyspark.sql import functions as F

    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(50)] + [(600, 600 + i) for i in range(1, 40)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = dict(runtime.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert all(got.get(n, n) == find(n) for n in root)
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("h"), "id", (F.col("id") % 5).alias("w"))
    ranks = rows_of(runtime.ranked(df, ["g"], "h", ["id"], "w"))
    for g in range(3):
        mine = sorted((r for r in ranks if r["g"] == g), key=lambda r: (r["h"] % (1 << 64)) >> 11)
        assert [r["rank"] for r in mine] == list(range(len(mine)))
        assert [r["before"] for r in mine] == [sum(x["w"] for x in mine[:i]) for i in range(len(mine))]
