"""Every query of the library: against its SQL on the smallest tables, or row by row against a plain version."""

from __future__ import annotations

import hashlib

import plain_core as P
import pytest
from oracle import compared, rows_of
from pyspark.sql import functions as F

from veilscan import fixtures as X
from veilscan import queries
from veilscan.functions import vocab as V

SF = "/root/testdata/sf0.001"
PLAIN = {"report_include", "ligature_repair", "html_pages", "snippet_greedy", "document_scan"}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name):
    mine, theirs = compared(queries.QUERIES[name](spark, SF), queries.SQL[name], SF)
    assert mine == theirs and theirs


def test_every_query_is_tested():
    assert set(queries.QUERIES) == set(queries.SQL) | PLAIN


def test_report_include(spark):
    got = {r.c_custkey: (r.include_in_report, r.reasons) for r in queries.report_include(spark, SF).collect()}
    people, kinds, found = (rows_of(sql, SF)[1] for sql in (f"SELECT c_custkey, relative_path, extension, text FROM ({X.PEOPLE}) p", queries.TYPES, X.FOUND))
    kind_of, cats = dict(kinds), {}
    for key, category, n in found:
        cats.setdefault(key, {})[category] = n
    assert len(got) == len(people) and {True, False} == {g[0] for g in got.values()}
    for key, path, ext, text in people:
        own = cats.get(key, {})
        assert P.assessed(path, ext, text, own, kind_of[key], "passport_rf" in own)[2:] == got[key], key


LOST = ["The specic identier of the prole nds nothing. Dene it, CONRM it.", "Specic ofce only, no second word lost?", "nd\n\n\n\nnds  \t x \0 y a\0b", "ﬁne ﬂow", "plain", "", "x" * 20_001 + " specic identier", "specic " + "y" * 20_000 + " identier nds"]


def test_ligature_repair(spark, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(LOST)], "doc_id bigint, text string")
    docs.unionByName(spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text")).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.text_sha256 for r in queries.ligature_repair(spark, str(tmp_path)).collect()}
    every = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect()}
    want = {i: hashlib.sha256(P.normalized(t).encode()).hexdigest() for i, t in every.items() if P.repaired(t + " ") != t + " "}
    assert got == want and {0, 2} <= set(got) and not {3, 4, 5, 6} & set(got)


def test_html_pages(spark):
    got = {r.page_id: r.text for r in queries.html_pages(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages) == len([p for p in pages if got[p.page_id]])
    squeezed = lambda t: [w for line in t.split("\n") for w in line.split()]
    for p in pages:
        assert squeezed(got[p.page_id]) == squeezed(P.normalized(P.page_text(p.html))), p.page_id


def test_snippet_greedy(spark):
    got = {r.video: r.text for r in queries.snippet_greedy(spark, SF).collect()}
    turns: dict = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.text))
    assert got == {k: P.snippets(v) for k, v in turns.items()} and any(got.values())


def test_document_scan(spark):
    """Categories, risk and the report rule of every document whose text needs no name, passport or identity rules."""
    rows = {r.doc_id: r for r in queries.document_scan(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    seen = set()
    for d in docs:
        r, own = rows[d.doc_id], P.found(d.text)
        if any(c in r.categories for c in ("passport", "foreign", "snils", "full_name", "driver")):
            continue
        assert r.categories == f"[{', '.join(sorted(own))}]", (d.doc_id, own)
        score, level, reported, _ = P.assessed(f"{d.source}/{d.doc_id}.txt", ".txt", d.text, own, r.document_type)
        assert (r.risk_score, r.risk_level, r.include_in_report) == (score, level, reported), d.doc_id
        assert r.document_type == (V.CARD_DOC if {"bank_card", "cvv"} & set(own) else V.UNKNOWN) or not own
        seen |= set(own)
    assert {"email", "phone"} <= seen


def test_broken_and_null_values(spark):
    """Null pages and values stay null; what is no JSON has no values."""
    from veilscan.sources.files import html_text, json_values

    d = spark.createDataFrame([(0, "<p>a</p>", '{"a": 1}'), (1, None, None), (2, "<p", "{broken"), (3, "", "")], "i int, html string, js string")
    got = {r.i: (r.h, r.j) for r in d.select("i", html_text("html").alias("h"), json_values("js").alias("j")).collect()}
    assert got[0] == ("a", ["a", "1"]) and got[1] == (None, None) and got[2][1] is None and got[3] == ("", None)
