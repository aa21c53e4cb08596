"""Detectors, masks, features, types and risk on texts with known contents."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from veilscan.functions import names, text, validators
from veilscan.functions import vocab as V
from veilscan.operators.detect import detect, findings
from veilscan.operators.features import half_even
from veilscan.plans.pipeline import score

SCHEMA = "relative_path string, extension string, size_bytes bigint, text string"
IDENTITY = "личное/a.txt", ".txt", 500, "Иванов Иван Иванович, паспорт серия 4510 номер 123456, выдан ОВД. Дата рождения 01.02.1980. тел. +7 (999) 123-45-67 email ivan@example.com СНИЛС 112-233-445 95"
PAYMENT = "backup/b.csv", ".csv", 500, "карта 4111 1111 1111 1111 cvv: 123 phone +79991234567 ИНН 7707083893 ИНН 500100732259 БИК 044525225 р/с 40702810900000000001"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def rows(spark, *texts, path="x.txt"):
    return spark.createDataFrame([t if isinstance(t, tuple) else (path, ".txt", 1, t) for t in texts], SCHEMA)


def counts(spark, t, path="x.txt"):
    r = detect(rows(spark, t, path=path)).first()
    return {k: v["count"] for k, v in r.categories.items()}


def inn_plain(d: str) -> bool:
    weights = {10: [[2, 4, 10, 3, 5, 9, 4, 6, 8]], 12: [[7, 2, 4, 10, 3, 5, 9, 4, 6, 8], [3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8]]}.get(len(d), [])
    return bool(weights) and all(sum(w * int(c) for w, c in zip(ws, d, strict=False)) % 11 % 10 == int(d[len(ws)]) for ws in weights)


def snils_plain(d: str) -> bool:
    if len(d) != 11 or len(set(d)) == 1:
        return False
    total = sum(int(c) * (9 - i) for i, c in enumerate(d[:9]))
    return (total if total < 100 else total % 101 % 100) == int(d[9:])


def test_checksums(spark):
    r = random.Random(1)
    numbers = ["7707083893", "0000000000", "500100732259", "11223344595", "10001899900", "10001989900", "01897392500", "11111111111", *("".join(r.choice("0123456789") for _ in range(n)) for n in (10, 11, 12) for _ in range(200))]
    got = spark.createDataFrame([(n,) for n in numbers], "v string").select("v", validators.inn_ok(F.col("v")).alias("inn"), validators.snils_ok(F.col("v")).alias("snils")).collect()
    for g in got:
        assert (g.inn, g.snils) == (inn_plain(g.v), snils_plain(g.v)), g
    cards = {"4111 1111 1111 1111": True, "4111111111111112": False, "411": False, "1900200020001900": True}
    assert {k: one(spark, validators.luhn_ok(F.lit(k))) for k in cards} == cards


@pytest.mark.parametrize(("category", "value", "masked"), [("email", "ivan@example.com", "iv***@example.com"), ("email", "ivan@", "6" and None), ("phone", "+7 999 123-45-67", "79***67"), ("cvv", "cvv 123", "***"), ("full_name", "Иванов Иван", "И*** И***"), ("mrz", "P<UTO", "P<***O"), ("mrz", "ab", "***"), ("foreign_id_document", "any", "identity_document_marker")])
def test_masks(spark, category, value, masked):
    got = one(spark, validators.mask(category, F.lit(value)))
    assert got == masked if masked else len(got) == 12
    assert value not in got


def test_names(spark):
    good = {"Иванов Иван Иванович": True, "Мария Петрова": True, "Петрова Мария": True, "Договор Поставки": False, "Иван Иванов Иванович": False, "Директор Иванов Иван": False, "Пётр Пётров": True, "Иванов": False, "Паспорт Иванов Иван": False}
    assert {k: one(spark, names.likely_name(names.candidate(F.lit(k)))) for k in good} == good


def test_offsets(spark):
    for t in ("1 22 333 é4😀55", "", "none", "7"):
        got = one(spark, text.located(F.lit(t), r"\d+"))
        import re

        assert [(s.value, s.start, s.end) for s in got] == [(m[0], *m.span()) for m in re.finditer(r"\d+", t)]


def test_identity_text(spark):
    r = score(rows(spark, IDENTITY)).first()
    assert {k: v["count"] for k, v in r.categories.items()} == {"email": 1, "phone": 1, "snils": 1, "full_name": 1, "birth_date": 1, "passport_rf": 1}
    assert r.signals.passport_context and r.features.has_full_identity_bundle and r.features.unique_persons == 1
    assert (r.risk_level, r.include_in_report) == ("high", True) and r.reasons[0].startswith("Risk components: pii_sensitivity=27")
    assert r.risk_score == r.sensitivity_score + r.massiveness_score + r.context_score - r.legitimacy_discount == 34


def test_payment_text(spark):
    r = score(rows(spark, PAYMENT)).first()
    assert set(r.categories) == {"bank_card", "cvv", "phone", "inn_person", "inn_legal", "bik", "bank_account"}
    assert r.document_type == V.CARD_DOC and r.features.has_card_and_phone and r.recommendation == V.RECOMMEND_HIGH
    assert r.validation["inn"].valid == 2 and r.validation["snils"].rejected == 1


@pytest.mark.parametrize(
    ("t", "want"),
    [
        ("паспорт: 4510 123456", {"passport_rf": 1}),
        ("паспорт: 4510123456", {"passport_rf": 1}),
        ("паспорт 4510 123455", {}),  # a valid INN
        ("номер 4510 123456", {}),
        ("ИНН 4510 123456 паспорт", {}),
        ("серия ____ номер ____ паспорт 4510 123456 выдан", {}),
        ("card 4111111111111111", {"bank_card": 1}),
        ("4111111111111111", {}),
        ("visa 1900 2000 2000 1900", {}),
        ("token 4111111111111111 card", {}),
        ("БИК 044525225", {"bik": 1}),
        ("код безопасности: 123", {"cvv": 1}),
        ("born 01.02.1980 or 1.2.1980", {"birth_date": 1}),
        ("01.02.1980", {}),
        ("P<UTOERIKSSON<<ANNA<MARIA<<<<<<<<<<<<<<<<<<<", {"mrz": 1}),
        ("водительское удостоверение", {}),
        ("водительское удостоверение № 12 34 567890", {"driver_license": 1}),
        ("зарегистрирована", {"address": 2}),
        ("раса", {"race": 1}),
        ("Czech Republic Identification card, datum narození 1.1.1980", {"foreign_id_document": 1}),
        ("Identity card, document no AB123456", {"foreign_id_document": 1}),
        ("Identity card", {}),
        ("ＩＤＥＮＴＩＴＹ ＣＡＲＤ document no AB123456", {"foreign_id_document": 1}),
        ("a@b.ru A@b.ru a@b.ru", {"email": 2}),
        ("8 (912) 345-67-89, (912) 345-67-89, телефон 912 345 67 89", {"phone": 3}),
        ("ТЕЛЕФОН: 912 345-67-89", {"phone": 1}),
        ("", {}),
    ],
)
def test_detectors(spark, t, want):
    assert counts(spark, t) == want


def test_path_counts_twice(spark):
    assert counts(spark, "", path="диагноз/диагноз.txt") == {"health": 3}


def test_nulls_long_and_extra_columns(spark):
    d = spark.createDataFrame([(None, None, None, None, 1), ("p", ".txt", 1, "x" * 300_000 + " a@b.ru", 2)], SCHEMA + ", names int")
    got = {r.relative_path: r for r in detect(d).collect()}
    assert got[None].categories == {} and got["p"].categories["email"]["count"] == 1 and got["p"].names == 2
    assert score(rows(spark)).count() == 0 if False else score(d.drop("names").limit(0)).count() == 0
    assert findings(detect(d), "relative_path").count() == 1


@pytest.mark.parametrize(("x", "digits", "want"), [(0.0625, 3, 0.062), (0.7995, 3, 0.799), (2.0005, 3, 2.001), (0.5, 0, 0.0), (1.23456, 4, 1.2346)])
def test_rounding(spark, x, digits, want):
    assert one(spark, half_even(F.lit(x), digits)) == want == round(x, digits)


def test_reports_low_value_and_public(spark):
    got = {r.relative_path: (r.risk_level, r.include_in_report, r.document_type) for r in score(rows(spark, ("выгрузки/сайты/a.html", ".html", 1, IDENTITY[3]), ("p.txt", ".txt", 1, "диагноз"), ("q.txt", ".txt", 1, "договор a@b.ru"), ("scan.png", ".png", 1, "паспорт: 4510 123456"))).collect()}
    assert got["выгрузки/сайты/a.html"][1] is True and got["p.txt"][1] is False and got["q.txt"] == ("low", False, V.CONTRACT)
    assert got["scan.png"] == ("high", True, V.PASSPORT_SCAN)
