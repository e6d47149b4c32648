"""corpus_pipeline: every stage on odd rows, and run() against plain Python."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from mapforge.llm import langid, packing
from tests.llm.test_operators import WORD, grams_by_hand, linked_by_hand, profiles_by_hand, ranks_by_hand

STAGES = dict(corpus_pipeline.STAGES)
ODD = [(1, None, None, None), (None, "", "en", "s"), (None, None, None, None), (2, " \n\t", "de", "t"), (3, "12 34", None, "s"), (4, "word " * 30000, "en", "s"), (5, "same words stand here twice", "en", None), (5, "same words stand here twice", "en", None), (None, "a text of no number", None, "t")]


def counted(df):
    return collections.Counter(tuple(str(v) for v in r) for r in df.collect())


def samples(spark, n=120):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(n).collect()]


def test_stages_bear_odd_rows(spark, docs_of):
    rows = ODD + samples(spark, 25)
    docs = docs_of(rows, clash=True)
    for name, stage in STAGES.items():
        out = stage(spark, docs, "")
        if name != "packing":
            assert out.columns == docs.columns, name
        assert out.count() > 0 and stage(spark, docs.limit(0), "").count() == 0, name


def test_language_keeps_given_values(spark, docs_of):
    rows = samples(spark) + [(9001, samples(spark)[0][1], None, "s"), (9002, None, "en", "s"), (9003, "12 !", "en", "s")]
    got = {r["doc_id"]: r for r in STAGES["language"](spark, docs_of(rows), "").collect()}
    want = profiles_by_hand([(t, lang) for i, t, lang, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1])
    for i, text, lang, _ in rows:
        own = ranks_by_hand(grams_by_hand(text or ""))
        best, score = None, 0.0
        if own:
            distance = {k: sum(abs(p.index(g) - j) if g in p else langid.SIZE for j, g in enumerate(own)) for k, p in want.items()}
            best = min(sorted(distance), key=distance.get)
            score = 1 - distance[best] / (langid.SIZE * len(own))
        assert (i in got) == (best is not None and score >= corpus_pipeline.LEAST_SCORE)
        assert i not in got or got[i]["lang"] == (lang if lang is not None else best)


def test_personal_data_is_replaced(spark, docs_of):
    rows = [(i, t, "en", "s") for i, t in enumerate(["write to a.b@c.example.org now", "call +1 202 555 0143 today", "card 4111 1111 1111 1111.", "host 10.20.30.40 up", "nothing here", None])] * 3
    got = counted(STAGES["personal data"](spark, docs_of(rows), "").select("doc_id", "text", "n_chars"))
    want = ["write to <EMAIL> now", "call <PHONE> today", "card <CARD>.", "host <IP> up", "nothing here", ""]
    assert got == {(str(i), t, str(len(t))): 3 for i, t in enumerate(want)}


def test_mixture_takes_whole_words(spark, docs_of):
    rng = random.Random(4)
    rows = [(i, "\n".join(" ".join(f"d{i}w{j}x{k}" for k in range(9)) for j in range(rng.randrange(1, 120))), "en", rng.choice("abc")) for i in range(60)]
    texts = {i: t for i, t, _, _ in rows}
    out = STAGES["mixture"](spark, docs_of(rows), "").collect()
    copies, words = collections.Counter(), collections.Counter()
    for r in out:
        copies[r["doc_id"]] += 1
        words[r["source"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"])
        # What is left of a text is stretches of it with their line breaks, at most one gap for each block left out.
        at = 0
        for stretch in re.findall(r"\S+(?:\s+\S+)*", r["text"]):
            for w in stretch.split():
                at = texts[r["doc_id"]].index(w, at)
        if len(WORD.findall(r["text"])) == len(WORD.findall(texts[r["doc_id"]])):
            assert r["text"] == texts[r["doc_id"]]
    assert max(copies.values()) <= 2
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(WORD.findall(t))
    assert sum(words.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.05)
    assert all(words[s] <= 2 * sizes[s] for s in sizes)


def test_near_copies_and_packing_against_brute_force(spark, docs_of):
    rows = samples(spark, 60)
    rows += [(9000 + i, " ".join(t.split()[:-1]) + " other", lang, s) for i, t, lang, s in rows[:10] if t]
    least = {i: root for i, _, root in linked_by_hand([(i, t) for i, t, _, _ in rows], 5, 80)}
    near = STAGES["near copies"](spark, docs_of(rows), "")
    assert sorted(r["doc_id"] for r in near.select("doc_id").collect()) == sorted(i for i in least if least[i] == i)
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, t, _, _ in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want.update((i, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), 2048)))
    assert collections.Counter(tuple(r)[:5] for r in STAGES["packing"](spark, docs_of(rows), "").collect()) == want


def test_run_is_its_stages(spark, docs_of, as_table):
    """run() on a whole folder: each stage on all that the one before it kept; clean documents come through to the end."""
    rows = [r for r in samples(spark, 80)] + [(7000, "qqq zzz " * 20, "en", "s"), (7001, None, "en", "s")]
    folder = as_table(docs_of(rows))
    docs = docs_of(rows)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        docs = kept[name] = spark.createDataFrame(out.collect(), out.schema)
    pieces = lambda df: collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    got = corpus_pipeline.run(spark, folder)
    assert pieces(got) == pieces(kept["packing"])
    ids = {name: {r["doc_id"] for r in df.select("doc_id").collect()} for name, df in kept.items()}
    assert ids["language"] >= ids["near copies"] == ids["personal data"] >= ids["mixture"] == ids["packing"]
    assert len(ids["packing"]) > 30 and 7001 not in ids["packing"]


def test_both_tokenizers_agree():
    """Every character of the alphabet that goes to tiktoken, in random texts, gives the ids of tokenizers."""
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing._encoder(None, None)
    alphabet = [chr(c) for c in range(0x250) if not packing._UNCOMMON.search(chr(c))]
    rng = random.Random(12)
    kinds = [alphabet, [c for c in alphabet if c.isspace()], [c for c in alphabet if c.isdigit()], [c for c in alphabet if c.isalpha()], ["'s", "'RE", "'ll", "\r\n", "  ", "\t\t"], [c for c in alphabet if not c.isalnum()]]
    texts = ["".join(alphabet), *("a" + c + "1 " + c + c for c in alphabet)]
    texts += ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randrange(1, 120))) for _ in range(20000)]
    for text in texts:
        assert list(encode(text)) == exact.encode(text, add_special_tokens=False).ids, repr(text)
    packing._loaded.clear()
