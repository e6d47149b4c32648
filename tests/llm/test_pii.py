import hashlib
import re

import duckdb

from mapforge.llm import pii
from mapforge.llm.queries import QUERIES

KINDS = ["email", "ip", "card", "phone"]
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")), "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()  # noqa: B023
            if ok:
                out.append((m.start(), KINDS.index(kind), m.end()))
    return [(KINDS[k], s, e) for s, k, e in sorted(out)]


ODD = [
    "a@b.c_d@e.f", "a@b.c.@x.y x@y", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.255", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (453) 555-6570 +12 +123456789012345678",
    "é😀 x@y.zz 😀4111111111111111", "+4111111111111111", "", None, "@@..@a.b", "a@b.c@d.e@f.g", "000000000000", "1" * 40, "x@" + "a." * 3000 + "b", "1 " * 5000, "7" * 20000, "b" * 20000,
    "mail me: joe (at) example (dot) com", "call (555) 234-5678 now", "ssn 123-45-6789", "1.1.1.1" * 50, "version 1.2.3.4",
]


def result(spark, folder):
    return sorted((r.asDict() for r in QUERIES["op1_pii"](spark, folder).collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))


def check(rows, texts):
    for r, text in zip(rows, texts, strict=True):
        spans = base_spans(text)
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in spans) for k in KINDS], text
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest(), text
        got = r["spans"].split(",") if r["spans"] else []
        assert {f"{k}:{s}:{e}" for k, s, e in spans} <= set(got)
        starts = [(int(x.split(":")[1]), pii.KINDS.index(x.split(":")[0])) for x in got]
        assert starts == sorted(starts)


def test_base_spans_are_those_of_the_plain_patterns(spark, docs_of, as_table):
    rows = [(i, t) for i, t in enumerate(ODD)]
    check(result(spark, as_table(docs_of(rows, clash=True))), ODD)


def test_whole_table_against_brute_force(spark):
    texts = [t for (t,) in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet' order by doc_id").fetchall()]
    check(result(spark, "/root/testdata/sf0.001"), texts)


def test_the_method_adds_likely_spans_and_no_others(spark, docs_of):
    rows = [(i, f"please call phone (555) 234-{5000 + i} or mail me{i}@mail.example.com today") for i in range(40)]
    rows += [(100 + i, f"order 123.456.{7000 + i}x is nobody's; phone +1 (453) 555-{6000 + i}") for i in range(40)] + [(200, "nothing here")]
    got = {r["doc_id"]: [(s["kind"], s["base"]) for s in r["spans"]] for r in pii.find_pii(docs_of(rows).select("doc_id", "text")).collect()}
    assert got[0] == [("phone", False), ("email", True)]
    assert got[100] == [("phone", True)] and got[200] == []


def test_empty_table_and_repeated_rows(spark, docs_of, as_table):
    assert result(spark, as_table(docs_of([]))) == []
    rows = result(spark, as_table(docs_of([(1, "a@b.cc"), (1, "a@b.cc"), (None, "a@b.cc")])))
    assert [r["spans"] for r in rows] == ["email:0:6"] * 3


def test_redaction_keeps_the_rest(spark, docs_of):
    df = docs_of([(1, "é a@b.cc +4111111111111111 end"), (2, "plain")]).select("doc_id", "text")
    found = pii.find_pii(df).join(df, "doc_id").select("doc_id", pii.redact(df["text"], pii.F.col("spans")).alias("t"))
    assert dict(found.collect()) == {1: "é <EMAIL> +<CARD> end", 2: "plain"}
