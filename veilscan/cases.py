"""Known cases of detection, types and risk: texts with what must be found in them.  Each customer of the driver's tables gets a case by its key.

The expected values follow from the rules by hand; they are literals here, and the SQL that queries are held against is
made of them alone.
"""

from __future__ import annotations

from .functions import vocab as V

#: (path, text, {category: count}); extensions are the path's.
DETECT: tuple[tuple[str, str, dict[str, int]], ...] = (
    ("a.txt", "a@b.ru A@b.ru a@b.ru x@y", {"email": 2}),
    ("a.txt", "8 (912) 345-67-89, (912) 345-67-89, телефон 912 345 67 89", {"phone": 3}),
    ("a.txt", "+7 999 1234567; mobile: 8(999)123 45 67; phone № 999 123-45-67", {"phone": 3}),
    ("a.txt", "18 912 345 67 89 and 912 345 67 89 alone", {}),
    ("a.txt", "паспорт: 4510 123456", {"passport_rf": 1}),
    ("a.txt", "паспорт: 45 10 123456", {"passport_rf": 1}),
    ("a.txt", "Passport No 4510 123456", {"passport_rf": 1}),
    ("a.txt", "паспорт 4510 123455", {}),  # a valid number of another kind
    ("a.txt", "номер 4510 123456", {}),
    ("a.txt", "серия и номер: 4511 654322, выдан отделом, фамилия Котов", {"passport_rf": 1}),
    ("a.txt", "passport uuid 4510 123456", {}),  # technical context
    ("a.txt", "passport %7b 4510 123456", {}),
    ("a.txt", "passport 12ab-34cd 4510 123456", {}),
    ("a.txt", "фамилия Котов, выдан отделом\nтел. номер 4510 123456", {}),  # the line is a telephone's
    ("a.txt", "ОГРН 4510 123456 passport", {}),  # the line is a firm's
    ("a.txt", "КПП 1, passport no 4510 123456", {}),  # bank words make it a template
    ("a.txt", "серия ____ номер ____ паспорт 4510 123456 выдан", {}),  # a blank form
    ("a.txt", "паспорт серия 4510 выдан когда-то номер 123456", {"passport_rf": 1}),
    ("a.txt", "сер. 45 10 и потом номер 123456", {"passport_rf": 1}),
    ("a.txt", "серия 4511 № 654322, предъявлен паспорт", {"passport_rf": 1}),
    ("a.txt", "паспорт рф серия 4510 123456; паспорт 4511 654322", {"passport_rf": 2}),
    ("a.txt", "СНИЛС 112-233-445 95 и 11223344595", {"snils": 2}),
    ("a.txt", "СНИЛС 112-233-445 96", {}),
    ("a.txt", "112-233-445 95", {}),
    ("a.txt", "snils token 112-233-445 95", {}),
    ("a.txt", "7707083893 и 500100732259, 7707083894", {"inn_legal": 1, "inn_person": 1}),
    ("a.txt", "0000000000", {"inn_legal": 1}),
    ("a.txt", "card 4111111111111111 and 4111 1111 1111 1111", {"bank_card": 2}),
    ("a.txt", "card 4111-1111-1111-1112", {}),
    ("a.txt", "4111111111111111", {}),
    ("a.txt", "visa 1900 2000 2000 1900", {}),
    ("a.txt", "token 4111111111111111 card", {}),
    ("a.txt", "БИК 044525225, bik: 044525226, бик 04452522", {"bik": 2}),
    ("a.txt", "р/с 40702810900000000001; счет № 40702810900000000002; 40702810900000000003", {"bank_account": 2}),
    ("a.txt", "CVV: 123, cvc 456, код безопасности: 789, cvv 12", {"cvv": 3}),
    ("a.txt", "P<UTOERIKSSON<<ANNA<MARIA<<<<<<<<<<<<<<<<<<< and IDUTOD231458907<<<7408122F1204159 and P<SHORT", {"mrz": 2}),
    ("a.txt", "Иванов Иван Иванович, Мария Петрова, Петрова Мария, Договор Поставки", {"full_name": 3}),
    ("a.txt", "Иван Иванов Иванович; Пётр Пётров", {"full_name": 1}),
    ("a.txt", "дата рождения: 01.02.1980\n3/4/1999 (д.р.)", {"birth_date": 2}),
    ("a.txt", "born 01.02.1980 or 1.2.1980", {"birth_date": 1}),
    ("a.txt", "01.02.1980; год рождения\n41.13.1980 born", {}),
    ("a.txt", "Identity card, document no AB123456", {"foreign_id_document": 1}),
    ("a.txt", "ＩＤＥＮＴＩＴＹ ＣＡＲＤ document no AB123456", {"foreign_id_document": 1}),
    ("a.txt", "Identity card", {}),
    ("a.txt", "Czech Republic Identification card, datum narození 1.1.1980", {"foreign_id_document": 1}),
    ("a.txt", "Občanský průkaz 1.1.2030", {"foreign_id_document": 1}),
    ("a.txt", "ID document: surname Novak nationality Czech sex M, place of birth Brno 1.1.1980 to 1.1.2030", {"foreign_id_document": 1}),
    ("a.txt", "ID document: surname Novak nationality Czech sex M, place of birth Brno 1.1.1980", {}),  # one date only
    ("a.txt", "National ID, number 12AB5678", {"foreign_id_document": 1}),
    ("a.txt", "водительское удостоверение", {}),
    ("a.txt", "водительское удостоверение № 12 34 567890, в/у", {"driver_license": 2}),
    ("a.txt", "зарегистрирована на ул. Мира, улица новая", {"address": 4}),
    ("a.txt", "место рождения Тверь, родился в мае", {"birth_place": 2}),
    ("a.txt", "отпечаток и биометрия", {"biometric": 2}),
    ("a.txt", "Диагноз, анамнез, полис ОМС", {"health": 3}),
    ("диагноз/диагноз.txt", "", {"health": 3}),
    ("a.txt", "религиозные убеждения и религия", {"religion": 2}),
    ("a.txt", "член партии, партийность", {"political_views": 2}),
    ("a.txt", "этническая принадлежность", {"nationality": 1}),
    ("a.txt", "раса, расовая принадлежность", {"race": 2}),
    ("a.txt", "", {}),
    ("a.txt", "Plain words without anything in them.", {}),
)

#: (folded text, label of the identity document that it names).
MARKERS: tuple[tuple[str, str | None], ...] = (
    ("Foreign identity card", "foreign identity card"),
    ("National Identification  Card no 5", "foreign identity card"),
    ("ID document", "foreign identity document"),
    ("identity document, national id", "foreign identity document"),
    ("national id 7", "foreign national id"),
    ("Občanský průkaz", "obcansky prukaz"),
    ("Czech republic and its identification", "czech identification card"),
    ("dentification carte", "foreign identity card"),
    ("identity", None),
    ("card of a foreign land", None),
)

#: (path, text, document type): every type, and the order of rules where two could hold.
TYPES: tuple[tuple[str, str, str], ...] = (
    ("p.html", "Политика конфиденциальности и паспорт: 4510 123456", V.POLICY),
    ("p.html", "Terms of Service", V.POLICY),
    ("p.txt", "Правила приёма в университет", V.ADMISSION),
    ("p.txt", "Правила приёма гостей, договор", V.CONTRACT),
    ("p.txt", "Согласие на обработку персональных данных", V.CONSENT),
    ("p.txt", "Согласие на обработку", V.UNKNOWN),
    ("p.png", "паспорт", V.PASSPORT_SCAN),
    ("passport.pdf", "words", V.PASSPORT_SCAN),
    ("p.pdf", "паспорт " + "x" * 3000, V.UNKNOWN),
    ("p.txt", "паспорт: 4510 123456", V.UNKNOWN),
    ("p.txt", "Identity card, document no AB123456", V.ID_CARD),
    ("p.txt", "водительское удостоверение", V.DRIVER),
    ("p.txt", "CVV: 123", V.CARD_DOC),
    ("p.txt", "card 4111111111111111", V.CARD_DOC),
    ("p.txt", "диагноз", V.MEDICAL),
    ("p.csv", "a@b.ru, (912) 345-67-89, Петрова Мария", V.ID_TABLE),
    ("p.csv", "a@b.ru, (912) 345-67-89, БИК 044525225", V.UNKNOWN),
    ("p.txt", "резервная копия", V.DUMP),
    ("x/dump/p.txt", "накладная", V.DUMP),
    ("p.txt", "Расписка: обязуюсь", V.RECEIPT),
    ("p.txt", "Счет-фактура и накладная", V.INVOICE),
    ("p.txt", "накладная к договору", V.WAYBILL),
    ("p.txt", "Приказ и договор", V.ORDER),
    ("p.txt", "договор", V.CONTRACT),
    ("p.txt", "Акт приёмки", V.ACT),
    ("p.txt", "факты", V.UNKNOWN),
    ("p.jpg", "nothing", V.PICTURE),
    ("p.tif", "nothing", V.UNKNOWN),
)

_NO = "No high-impact personal category found (-2 legitimate context)"
_ONLY = "Only contact/legal-entity requisites found (-4 legitimate context)"
_WEAK = "Special-category words without a concrete person anchor (-8 legitimate context)"
#: (path, text, sensitivity, massiveness, context, discount, level, reported, reasons after the first).
RISKS: tuple[tuple[str, str, int, int, int, int, str, bool, tuple[str, ...]], ...] = (
    ("p.txt", "words", 0, 0, 0, 2, "low", False, (_NO,)),
    ("p.txt", "a@b.ru", 1, 0, 0, 6, "low", False, ("email: 1 found (+1)", _ONLY, _NO)),
    ("p.txt", "договор a@b.ru", 1, 0, 0, 12, "low", False, ("email: 1 found (+1)", "Formal business context without personal high-impact identifiers (-4 legitimate context)", "Likely legitimate business document with benign/legal-entity categories (-5 legitimate context)", _ONLY, _NO)),
    ("p.txt", "диагноз", 4, 0, 3, 8, "low", False, ("health: 1 found (+4)", "Medical context with health data (+3 context)", _WEAK)),
    ("p.txt", "раса", 4, 0, 0, 8, "low", False, ("race: 1 found (+4)", _WEAK)),
    ("p.txt", "privacy policy a@b.ru", 1, 0, 0, 12, "low", False, ("email: 1 found (+1)", "Public policy/terms with only contact or legal-entity data (-8 legitimate context)", _ONLY, _NO)),
    ("p.txt", "privacy policy: диагноз", 1, 0, 0, 12, "low", False, ("health: 1 public/regulatory mentions (+1 weak context)", "Public policy/terms context lowers weak special-category mentions (-10 legitimate context)", _WEAK)),
    ("p.txt", "Правила приема в университет: диагноз, анамнез", 1, 0, 0, 12, "low", False, ("health: 2 public/regulatory mentions (+1 weak context)", "Public admission/regulatory document with weak PII mentions (-8 legitimate context)", _WEAK)),
    ("p.txt", "card 4111111111111111, тел. (912) 345-67-89", 11, 0, 0, 0, "high", True, ("bank_card: 1 found (+5)", "phone: 1 found (+1)", "Bank card plus phone detected (+5 sensitivity)")),
    ("p.txt", "CVV: 123", 9, 0, 0, 0, "medium", True, ("cvv: 1 found (+6)", "Payment data bundle detected (+3 sensitivity)")),
    ("p.txt", "БИК 044525225, р/с 40702810900000000001", 3, 0, 0, 6, "low", False, ("bank_account: 1 found (+2)", "bik: 1 found (+1)", _ONLY, _NO)),
    ("scan.png", "паспорт: 4510 123456", 7, 0, 14, 0, "high", True, ("passport_rf: 1 found (+5)", "Passport context confirmed around passport-like number (+2 sensitivity)", "Image file contains high-impact PII (+5 context)", f"Document type is {V.PASSPORT_SCAN} (+5 context)", "Suspicious file or directory name (+4 context)")),
    ("v.mp4", "CVV: 123", 9, 0, 5, 0, "high", True, ("cvv: 1 found (+6)", "Payment data bundle detected (+3 sensitivity)", "Video frame OCR contains high-impact PII (+5 context)")),
    ("p.txt", "Identity card, document no AB123456", 8, 0, 5, 0, "high", True, ("foreign_id_document: 1 found (+6)", "Foreign identity document context detected (+2 sensitivity)", f"Document type is {V.ID_CARD} (+5 context)")),
    ("backup/p.txt", "words", 0, 0, 14, 2, "high", False, ("Dump/backup/export context (+5 context)", "Document type is export/dump (+5 context)", _NO, "Suspicious file or directory name (+4 context)")),
    ("billing/p.txt", "words", 0, 0, 9, 2, "medium", False, ("Dump/backup/export context (+5 context)", _NO, "Suspicious file or directory name (+4 context)")),
    ("личное/p.txt", "Петрова Мария a@b.ru (912) 345-67-89", 7, 1, 4, 2, "medium", True, ("email: 1 found (+1)", "full_name: 1 found (+2)", "phone: 1 found (+1)", "Name plus multiple contact categories detected (+3 sensitivity)", "Elevated value PII density (+1 massiveness)", _NO, "Suspicious file or directory name (+4 context)")),
    ("p.txt", "Петрова Мария a@b.ru (912) 345-67-89", 7, 1, 0, 2, "medium", False, ("email: 1 found (+1)", "full_name: 1 found (+2)", "phone: 1 found (+1)", "Name plus multiple contact categories detected (+3 sensitivity)", "Elevated value PII density (+1 massiveness)", _NO)),
    ("p.txt", "Петрова Мария 500100732259 a@b.ru", 13, 1, 0, 0, "high", True, ("email: 1 found (+1)", "full_name: 1 found (+2)", "inn_person: 1 found (+4)", "Full identity bundle: name plus strong identifiers/contact data (+6 sensitivity)", "Elevated value PII density (+1 massiveness)")),
    ("p.txt", "Петрова Мария паспорт: 4510 123456", 14, 0, 0, 0, "high", True, ("full_name: 1 found (+2)", "passport_rf: 1 found (+5)", "Government ID bundle detected (+5 sensitivity)", "Passport context confirmed around passport-like number (+2 sensitivity)")),
    ("выгрузки/сайты/p.html", "Петрова Мария a@b.ru (912) 345-67-89", 7, 1, 0, 2, "medium", False, ("email: 1 found (+1)", "full_name: 1 found (+2)", "phone: 1 found (+1)", "Name plus multiple contact categories detected (+3 sensitivity)", "Elevated value PII density (+1 massiveness)", _NO)),
    ("otchet/p.txt", "CVV: 123", 9, 0, 0, 0, "medium", False, ("cvv: 1 found (+6)", "Payment data bundle detected (+3 sensitivity)")),
    ("p.txt", "a1@b.ru a2@b.ru a3@b.ru a4@b.ru a5@b.ru", 3, 3, 0, 6, "low", False, ("email: 5 found (+1+2 count)", "High value PII density (+3 massiveness)", _ONLY, _NO)),
    ("p.json", "a1@b.ru a2@b.ru a3@b.ru a4@b.ru a5@b.ru", 3, 5, 0, 6, "low", False, ("email: 5 found (+1+2 count)", "High value PII density (+3 massiveness)", "Structured file contains repeated PII-like values (+2 massiveness)", _ONLY, _NO)),
    ("p.txt", "CVV: 123, cvc 456, код безопасности: 789", 11, 3, 0, 0, "high", True, ("cvv: 3 found (+6+2 count)", "Payment data bundle detected (+3 sensitivity)", "Several sensitive identifiers (>=3) (+2 massiveness)", "Elevated value PII density (+1 massiveness)")),
    ("p.txt", "Расписка: обязуюсь, a@b.ru", 1, 0, 3, 6, "low", False, ("email: 1 found (+1)", "Personal receipt with identifiers/contact data (+3 context)", _ONLY, _NO)),
    ("p.txt", " ".join(f"a{i}@b.ru" for i in range(30)), 4, 8, 0, 6, "medium", False, ("email: 30 found (+1+3 count)", "Many non-keyword PII findings (>=30) (+5 massiveness)", "High value PII density (+3 massiveness)", _ONLY, _NO)),
    ("p.txt", "Петрова Мария, Петрова Анна, Петрова Вера, Петрова Елена, Петрова Ирина", 4, 6, 0, 2, "medium", False, ("full_name: 5 found (+2+2 count)", "High value PII density (+3 massiveness)", "Multiple distinct full names (>=5) (+3 massiveness)", _NO)),
)


def extension(path: str) -> str:
    return path[path.rindex(".") :].lower()


def text_literal(text: str) -> str:
    """A string of SQL that both engines read alike: neither backslashes nor quotes, line ends by their code."""
    assert "'" not in text and "\\" not in text
    return "'" + text.replace("\n", "' || chr(10) || '") + "'"


def pick(values) -> str:
    """The value of a key's case, as SQL that both engines read."""
    return f"case c_custkey % {len(values)} " + " ".join(f"when {i} then {v}" for i, v in enumerate(values)) + " end"


def texts(cases: tuple) -> str:
    """One file for each customer, with the path and text of its case."""
    paths = [c[0] for c in cases]
    return f"SELECT c_custkey, {pick([text_literal(p) for p in paths])} AS relative_path, {pick([text_literal(extension(p)) for p in paths])} AS extension, cast(1 as bigint) AS size_bytes, {pick([text_literal(c[1]) for c in cases])} AS text FROM customer"
