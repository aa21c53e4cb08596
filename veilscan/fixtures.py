"""Rows with known personal data, made from driver tables by SQL that Spark and DuckDB read alike.

The driver's texts hold few of the categories, so the queries on them use these views: people_sql gives a text for each
customer, of a kind by the key modulo 9; files_sql gives documents a place in a tree of files.
"""

from __future__ import annotations

# Ways of the SQL that both engines have: string casts, ||, %, floor, lpad, CASE.
INN_WEIGHTS = (2, 4, 10, 3, 5, 9, 4, 6, 8)
BASE = "(c_custkey * 7919 + 100000000)"


def digit(number: str, place: int, digits: int) -> str:
    """The place-th digit (from 0) of a number of so many digits."""
    return f"(cast(floor({number} / {10 ** (digits - 1 - place)}) as bigint) % 10)"


def weighted(number: str, digits: int, weights: tuple[int, ...]) -> str:
    return "(" + " + ".join(f"{w} * {digit(number, i, digits)}" for i, w in enumerate(weights)) + ")"


CHECK = f"({weighted(BASE, 9, INN_WEIGHTS)} % 11 % 10)"
#: Every third key has a wrong check digit.
INN = f"(cast({BASE} as string) || cast(({CHECK} + case when c_custkey % 3 = 0 then 1 else 0 end) % 10 as string))"
SNILS_SUM = weighted(BASE, 9, (9, 8, 7, 6, 5, 4, 3, 2, 1))
SNILS_CONTROL = f"(case when {SNILS_SUM} < 100 then {SNILS_SUM} else {SNILS_SUM} % 101 % 100 end)"
#: Every fifth key has a wrong control number.
SNILS = f"(substr(cast({BASE} as string), 1, 3) || '-' || substr(cast({BASE} as string), 4, 3) || '-' || substr(cast({BASE} as string), 7, 3) || ' ' || lpad(cast(({SNILS_CONTROL} + case when c_custkey % 5 = 0 then 1 else 0 end) % 100 as string), 2, '0'))"
TWO = "lpad(cast(c_custkey % 100 as string), 2, '0')"

PEOPLE = f"""
SELECT c_custkey,
  case c_custkey % 4 when 0 then 'personal/' when 1 then 'backup/' when 2 then 'misc/' else 'docs/' end || cast(c_custkey as string) || case c_custkey % 3 when 0 then '.txt' when 1 then '.csv' else '.pdf' end AS relative_path,
  case c_custkey % 3 when 0 then '.txt' when 1 then '.csv' else '.pdf' end AS extension,
  cast(1000 + c_custkey as bigint) AS size_bytes,
  case c_custkey % 9
    when 0 then 'клиент: Иванов Иван Иванович, email u' || cast(c_custkey as string) || '@example.com, тел. +7 (912) 345-67-' || {TWO}
    when 1 then 'организация, ИНН ' || {INN}
    when 2 then 'СНИЛС ' || {SNILS}
    when 3 then 'карта visa 4111 1111 1111 1111, cvv: 1' || {TWO} || ', тел. 8 912 345 67 ' || {TWO}
    when 4 then 'диагноз и анализ крови, диагноз номер ' || {TWO}
    when 5 then 'р/с 408028100000000000' || {TWO} || ', БИК 0440000' || {TWO}
    when 6 then 'дата рождения: 0' || cast(1 + c_custkey % 9 as string) || '.02.1980, национальность указана'
    when 7 then 'паспорт: 4510 1' || {TWO} || '456, выдан отделом, фамилия Петрова'
    else 'без данных ' || {TWO}
  end AS text
FROM customer"""

#: What is in those texts, as findings: a category and its count.
FOUND = f"""
SELECT c_custkey, category, n FROM (
  SELECT c_custkey, 'full_name' AS category, 1 AS n FROM customer WHERE c_custkey % 9 = 0
  UNION ALL SELECT c_custkey, 'email', 1 FROM customer WHERE c_custkey % 9 = 0
  UNION ALL SELECT c_custkey, 'phone', 1 FROM customer WHERE c_custkey % 9 IN (0, 3)
  UNION ALL SELECT c_custkey, 'inn_legal', 1 FROM customer WHERE c_custkey % 9 = 1 AND c_custkey % 3 <> 0
  UNION ALL SELECT c_custkey, 'snils', 1 FROM customer WHERE c_custkey % 9 = 2 AND c_custkey % 5 <> 0
  UNION ALL SELECT c_custkey, 'bank_card', 1 FROM customer WHERE c_custkey % 9 = 3
  UNION ALL SELECT c_custkey, 'cvv', 1 FROM customer WHERE c_custkey % 9 = 3
  UNION ALL SELECT c_custkey, 'health', 3 FROM customer WHERE c_custkey % 9 = 4
  UNION ALL SELECT c_custkey, 'bank_account', 1 FROM customer WHERE c_custkey % 9 = 5
  UNION ALL SELECT c_custkey, 'bik', 1 FROM customer WHERE c_custkey % 9 = 5
  UNION ALL SELECT c_custkey, 'birth_date', 1 FROM customer WHERE c_custkey % 9 = 6
  UNION ALL SELECT c_custkey, 'nationality', 1 FROM customer WHERE c_custkey % 9 = 6
  UNION ALL SELECT c_custkey, 'passport_rf', 1 FROM customer WHERE c_custkey % 9 = 7 AND NOT ({weighted("(cast('45101' || " + TWO + " || '45' as bigint))", 9, INN_WEIGHTS)} % 11 % 10 = 6)
) f"""

EXTENSIONS = (".txt", ".csv", ".json", ".docx", ".pdf", ".html", ".png", ".mp4", ".exe", "")
FILES = f"""
SELECT doc_id, source || '/' || case when doc_id % 23 = 0 then '~$' else '' end || cast(doc_id as string) || {"case cast(doc_id % 10 as int) " + " ".join(f"when {i} then '{e}'" for i, e in enumerate(EXTENSIONS)) + " end"} AS relative_path,
  {"case cast(doc_id % 10 as int) " + " ".join(f"when {i} then '{e}'" for i, e in enumerate(EXTENSIONS)) + " end"} AS extension,
  n_chars * 10000 AS size_bytes
FROM documents"""
