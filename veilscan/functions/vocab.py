"""Categories, word lists and weights.  Everything here is data: fixed values that results depend on."""

from __future__ import annotations

# --- Categories (fixed values) ---
DIRECT = ("passport_rf", "foreign_id_document", "snils", "inn_person", "driver_license", "mrz")
CONTACT = ("phone", "email", "address")
FINANCIAL = ("bank_card", "bank_account", "bik", "cvv")
DEMOGRAPHIC = ("birth_date", "birth_place", "nationality", "race")
#: Special categories as features count them, and as risk rules do: the two differ on purpose.
SPECIAL_FEATURES = ("health", "religion", "political_views", "biometric")
SPECIAL_RISK = ("health", "religion", "political_views", "nationality", "race", "biometric")
WEAK = ("address", "birth_place", "health", "religion", "political_views", "nationality", "race", "biometric")
LEGAL = ("inn_legal", "bik", "bank_account")
HIGH_IMPACT = (*DIRECT, "bank_card", "cvv", *SPECIAL_RISK)
BENIGN = ("full_name", "phone", "email", "address", "inn_legal", "bik", "bank_account")
#: Categories that keep a public policy from being discounted.
STRICT = ("passport_rf", "foreign_id_document", "snils", "inn_person", "bank_card", "cvv", "mrz")
REQUISITES = ("address", "phone", "email", "inn_legal", "bik", "bank_account")
SENSITIVE_TABLE = ("passport_rf", "foreign_id_document", "snils", "inn", "inn_person", "driver_license", "mrz", "bank_card", "bank_account", "bik", "cvv", "biometric", "health", "religion", "political_views", "nationality", "race")
IDENTIFIER_TABLE = ("full_name", "passport_rf", "foreign_id_document", "snils", "inn", "inn_person", "phone", "email", "address", "birth_date", "bank_card")
DIGIT_MASKED = ("phone", "passport_rf", "snils", "inn", "inn_person", "inn_legal", "bank_card", "bank_account", "bik", "cvv", "birth_date")

POINTS = {
    "mrz": 6, "foreign_id_document": 6, "cvv": 6, "passport_rf": 5, "snils": 5, "driver_license": 5, "bank_card": 5, "biometric": 5,
    "inn_person": 4, "health": 4, "religion": 4, "political_views": 4, "nationality": 4, "race": 4, "birth_date": 2, "birth_place": 2,
    "bank_account": 2, "full_name": 2, "phone": 1, "email": 1, "address": 1, "inn_legal": 1, "bik": 1, "inn": 3,
}
MEDIUM, HIGH = 6, 11

# --- File kinds (fixed values) ---
TEXT_EXT = (".txt", ".md", ".log")
STRUCTURED_EXT = (".csv", ".json", ".parquet")
OFFICE_EXT = (".docx", ".doc", ".rtf", ".xlsx", ".xls")
PDF_EXT = (".pdf",)
HTML_EXT = (".html", ".htm")
IMAGE_EXT = (".png", ".jpg", ".jpeg", ".tif", ".tiff", ".gif")
VIDEO_EXT = (".mp4", ".avi", ".mov", ".mkv", ".webm", ".mpeg", ".mpg")
SUPPORTED_EXT = (*TEXT_EXT, *STRUCTURED_EXT, *OFFICE_EXT, *PDF_EXT, *HTML_EXT, *IMAGE_EXT, *VIDEO_EXT)
HEAVY_EXT = (*OFFICE_EXT, *PDF_EXT, *HTML_EXT, *IMAGE_EXT, *VIDEO_EXT)
ANALYSED_TABLES = (".csv", ".xlsx", ".xls", ".parquet")
RISK_TABLES = (*ANALYSED_TABLES, ".json")
SCAN_EXT = (".jpg", ".jpeg", ".png", ".tif", ".tiff", ".gif", ".mp4", ".avi", ".mov", ".mkv", ".webm")

# --- Keywords by category (fixed values) ---
KEYWORDS = {
    "address": ("адрес регистрации", "адрес проживания", "зарегистрирован", "зарегистрирована", "проживает", "место жительства", "место регистрации", "улица", " ул."),
    "birth_place": ("место рождения", "родился в", "родилась в"),
    "driver_license": ("водительское удостоверение", "водительские права", "в/у", "driver license"),
    "biometric": ("отпечаток", "биометрия", "радужная оболочка", "голосовой образец", "распознавание лица", "изображение лица"),
    "health": ("диагноз", "медицинская карта", "анализ крови", "анализ мочи", "результаты анализов", "медицинское заключение", "история болезни", "инвалидность", "полис омс", "больничный", "анамнез"),
    "religion": ("вероисповедание", "религия", "религиозные убеждения"),
    "political_views": ("политические взгляды", "партийность", "член партии", "политическая партия"),
    "nationality": ("национальность", "этническая принадлежность"),
    "race": ("расовая принадлежность", "раса"),
}
BUSINESS_WORDS = ("договор", "стороны", "исполнитель", "заказчик", "счет-фактура", "накладная", "акт", "приказ", "распоряжение", "ооо", "кпп", "юридический адрес", "главный бухгалтер")

# --- Patterns (fixed values); flags: U Unicode classes, i any case, s dot matches all ---
BIRTH = r"(?:0?[1-9]|[12]\d|3[01])[./-](?:0?[1-9]|1[0-2])[./-](?:19|20)\d{2}"
PATTERNS = {
    "email": r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "phone": r"(?iU)(?<!\d)(?:\+7|8)[\s(-]*\d{3}[\s)-]*\d{3}[\s-]?\d{2}[\s-]?\d{2}(?!\d)|(?<!\d)\(\s*\d{3}\s*\)\s*\d{3}[\s-]?\d{2}[\s-]?\d{2}(?!\d)|\b(?:тел(?:ефон)?|phone|mobile)\b\s*[:№#-]?\s*(?:\+7|8)?[\s(-]*\d{3}[\s)-]*\d{3}[\s-]?\d{2}[\s-]?\d{2}(?!\d)",
    "passport_rf": r"(?U)\b\d{2}\s?\d{2}\s?\d{6}\b",
    "snils": r"(?U)\b\d{3}[- ]?\d{3}[- ]?\d{3}[- ]?\d{2}\b",
    "inn": r"(?U)\b(?:\d{10}|\d{12})\b",
    "bank_card": r"(?U)(?<![A-Za-z0-9])(?:\d{4}[ -]?){3}\d{4}(?![A-Za-z0-9])",
    "bik": r"(?iU)\b(?:БИК|BIK)\s*[:№#-]?\s*(\d{9})\b",
    "bank_account": r"(?iU)\b(?:р/с|счет|расчетный счет|лицевой счет)\s*[:№#-]?\s*(\d{20})\b",
    "cvv": r"(?iU)\b(?:CVV|CVC|код безопасности)\s*[:№#-]?\s*(\d{3})\b",
    "mrz": r"(?U)\b(?:P<|ID|I<)[A-Z0-9<]{20,}\b",
    "full_name": r"(?U)\b[А-ЯЁ][а-яё-]{2,}\s+[А-ЯЁ][а-яё-]{2,}(?:\s+[А-ЯЁ][а-яё-]{2,})?\b",
}
PASSPORT_IN_CONTEXT = (
    r"(?isU)\bпаспорт(?:\s+рф|\s+гражданина\s+рф)?\b.{0,120}?(?:серия\s*)?(\d{2}\s?\d{2}).{0,80}?(?:№|номер|no\.?|n\s*)?\s*(\d{6})\b",
    r"(?isU)\b(?:серия\s*)?(\d{2}\s?\d{2}).{0,40}?(?:№|номер|no\.?|n\s*)\s*(\d{6})\b.{0,80}?\bпаспорт\b",
    r"(?isU)\b(?:серия|сер\.?)\s*(\d{2}\s?\d{2})\b.{0,80}?\b(?:номер|№|no\.?|n)\s*(\d{6})\b",
)
BIRTH_IN_CONTEXT = (
    rf"(?isU)\b(?:дата\s+рождения|дата_рождения|д\.?\s*р\.?|родил(?:ся|ась)?|год\s+рождения|birth[_\s-]*date|date[_\s-]*of[_\s-]*birth|dob|born)\b[^\n\r]{{0,80}}?\b({BIRTH})\b",
    rf"(?isU)\b({BIRTH})\b[^\n\r]{{0,50}}?\b(?:дата\s+рождения|дата_рождения|д\.?\s*р\.?|birth[_\s-]*date|date[_\s-]*of[_\s-]*birth|dob)\b",
)
DRIVER_NUMBER = r"(?isU)\b(?:водительское\s+удостоверение|водительские\s+права|в/у|driver\s+license)\b[^\n\r]{0,100}?(?:№|номер|серия|no\.?|n)?\s*\d{2}\s?\d{2}\s?\d{6}\b"
TECHNICAL = r"(?U)%[0-9a-f]{2}|[0-9a-f]{4,}-[0-9a-f-]{4,}|\b(?:id|oid|uuid|guid|token|hash|session|objectid)\b"
LEGAL_LINE = r"(?U)\b(?:инн|кпп|огрн|окпо|октмо|окато|бик|уин|кбк|снилс|екс|уфк)\b|\b(?:банк\s+получателя|р/с|к/с|расч[её]тн(?:ый|ого)\s+счет|л\.?сч\.?|лицев(?:ой|ого)\s+счет)\b"
CONTACT_LINE = r"(?U)\b(?:тел\.?|телефон|факс|fax|phone|mobile)\b"
PASSPORT_WORD = r"(?U)\b(?:паспорт|passport)\b"
SERIES_OR_NUMBER = r"(?U)\b(?:серия|сер\.?|номер|№|no\.?)\b"
SERIES_WORD = r"(?U)\b(?:серия|сер\.?)\b"
NUMBER_WORD = r"(?U)№|\b(?:номер|no\.?|n)\b"
PASSPORT_LABEL = r"(?U)(?:паспорт|passport)\s*[:№#-]?\s*$"
BANK_TEMPLATE = r"(?U)\b(?:кбк|екс|бик|инн|кпп|октмо|расч[её]тн(?:ый|ого)\s+счет|банк\s+получателя)\b"
PLACEHOLDER = r"_{2,}|—{2,}|-{2,}|\.{3,}"
CARD_WORD = r"(?U)\b(?:карта|банковская\s+карта|номер\s+карты|сбербанк|visa|mastercard|mir|card|cardholder|pan|cvv|cvc)\b"
SNILS_WORD = r"(?U)\b(?:снилс|страховой\s+номер|snils)\b"
ISSUER_PHRASES = ("выдан", "кем выдан", "дата выдачи", "код подразделения", "личный код")
PERSON_PHRASES = ("фамилия", "отчество", "дата рождения", "место рождения")
TEMPLATE_PHRASES = ("паспорт", "выдан", "дата выдачи", "серия", "номер", "код подразделения")
ID_FIELDS = tuple(rf"\b{x}\b" for x in ("surname", "given names?", "open names?", "date of birth", "place of birth", "nationality", "holder s signature", "document no", "sex", "cislo dokladu", "datum narozeni", "misto narozeni", "statni obcanstvi", "platnost", "jmeno", "prijmeni"))
ID_MARKERS = (
    (r"\b(?:foreign|national|state)?\s*(?:identity|identification)\s+card\b", "foreign identity card"),
    (r"\b(?:id|identity)\s+document\b", "foreign identity document"),
    (r"\bnational\s+id\b", "foreign national id"),
    (r"\bobcansk\w*\s+pr\w{2,8}\b", "obcansky prukaz"),
    (r"\bczech\s+repub\w*.{0,30}\b(?:identity|identification|dentification)\b", "czech identification card"),
    (r"\b(?:identity|identification|dentification)\s+ca\w*\b", "foreign identity card"),
)
ID_NUMBER = r"\b(?:document|doklad|card|id)\s*(?:no|number|#)\b.{0,35}\b(?=[a-z0-9]*\d)[a-z0-9]{6,12}\b|\b(?:cislo|no|number)\b.{0,20}\b(?=[a-z0-9]*\d)[a-z0-9]{6,12}\b"
ID_FILLED = r"\b(?:surname|given names?|jmeno|prijmeni|nationality)\b\s+[a-z]{3,}(?:\s+[a-z]{3,}){0,2}\b"
ID_CZECH = r"\b(?:obcansk\w*|vncansk\w*)\s+(?:pr\w{2,8}|prokaz|paijuay)\b"
ID_CZECH_STATE = r"\b(?:ceska|czech)\s+repub\w*\b"
ID_CZECH_WORD = r"\b(?:identification|dentification)\b"
ANY_DATE = r"(?U)\b\d{1,2}[./-]\d{1,2}[./-](?:\d{2}|\d{4})\b"

# --- Names (fixed values) ---
FIRST_NAMES = (
    "александр александра алексей алена алина анастасия анатолий андрей анна антон артем вера виктор виктория владимир владислав галина дарья денис дмитрий евгений евгения екатерина елена иван игорь илья инна ирина кирилл константин ксения любовь людмила максим марина мария михаил наталья никита николай оксана олег ольга павел петр роман светлана сергей станислав татьяна юлия юрий"
).split()
NAME_STOPWORDS = (
    "адрес акт банк бик город гражданин гражданина договор документ заказчик заявление инн исполнитель копия накладная номер организация паспорт приказ россия российская свидетельство серия снилс сторона стороны счет таблица федерация"
).split()
PATRONYMIC_END = r"(?:вич|вна|ич|ична|оглы|кызы)\z"
SURNAME_END = r"(?:ов|ова|ев|ева|ин|ина|ын|ына|ский|ская|цкий|цкая|ской|енко|ко|ук|юк|ичева|ичев)\z"

# --- Document types and the phrases that give them (fixed values) ---
POLICY, ADMISSION, CONSENT = "публичная политика или условия сервиса", "публичный регламент или правила приема", "согласие на обработку ПДн"
PASSPORT_SCAN, ID_CARD, DRIVER, CARD_DOC, MEDICAL = "скан паспорта", "удостоверение личности", "водительское удостоверение", "банковская карта или платежный документ", "медицинский документ"
ID_TABLE, DUMP, RECEIPT, INVOICE, WAYBILL = "таблица с идентификаторами", "выгрузка или дамп", "личная расписка", "счет", "накладная"
ORDER, CONTRACT, ACT, PICTURE, UNKNOWN = "приказ", "договор", "акт", "изображение или скриншот", "неизвестный документ"
POLICY_PHRASES = ("политика конфиденциальности", "privacy policy", "terms of service", "пользовательское соглашение", "условия использования")
ADMISSION_PHRASES = ("правила приема", "правила приёма", "порядок приема", "порядок приёма", "прием на обучение", "приём на обучение", "вступительных испытаний", "поступающие")
EDUCATION_WORDS = ("университет", "обучение", "образовательн", "бакалавриат", "магистратур")
DUMP_WORDS = ("dump", "backup", "выгрузка", "резервная копия")
RECEIPT_WORDS = ("расписка", "обязуюсь", "получил денежные средства")
INVOICE_WORDS = ("счет-фактура", "счет на оплату", "расчетный счет")

# --- Paths (fixed values) ---
PUBLIC_WEB = ("выгрузки/сайты", "выгрузки/сайты")  # й composed and decomposed
SUSPICIOUS_PATHS = ("billing", "employes", "employees", "мои бумажки", "архив сканы", "личное", "backup", "dump", "temp", "tmp", "passport", "паспорт", "snils", "снилс", "card", "карта", "копия", "photo", "фото", "scan", "сканы")
PUBLIC_PATHS = ("samoobsled", "otchet", "отчет", "публичн", "fin_result", "координаты для связи", "03-5-01-005")
PERSONAL_PATHS = ("мои бумажки", "личное", "home_office", "home-office", "home office", "dostavka", "доставка", "propusk", "пропуск", "zayavka", "заявка", "zayavlenie", "заявление")
DUMP_PATHS = ("dump", "backup", "резервная копия", "billing", "employes", "employees", "мои бумажки")
DUMP_CONTENT = ("dump", "backup", "резервная копия")
RECOMMEND_HIGH = "Ручная проверка в первую очередь; при подтверждении перенести в защищенный контур или удалить при отсутствии основания хранения."
RECOMMEND_MEDIUM = "Ручная проверка; уточнить основание хранения и необходимость маскирования или переноса."
RECOMMEND_LOW = "Не включать в приоритетный отчет; хранить только технические признаки анализа."

# --- Text repair and quality (fixed values) ---
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
LOST_LIGATURES = {
    "reect": "reflect", "reects": "reflects", "reected": "reflected", "reecting": "reflecting", "eect": "effect", "eects": "effects", "eected": "effected", "eective": "effective", "eectively": "effectively",
    "dene": "define", "denes": "defines", "dened": "defined", "dening": "defining", "denition": "definition", "denitions": "definitions", "nd": "find", "nds": "finds", "nding": "finding",
    "specic": "specific", "specically": "specifically", "servicespecic": "service-specific", "articial": "artificial", "articially": "artificially", "identier": "identifier", "identiers": "identifiers",
    "aliate": "affiliate", "aliates": "affiliates", "aliated": "affiliated", "prole": "profile", "proles": "profiles", "verication": "verification", "conrm": "confirm", "conrms": "confirms", "conrmed": "confirmed", "conrming": "confirming",
    "congure": "configure", "congures": "configures", "congured": "configured", "conguring": "configuring", "oer": "offer", "oers": "offers", "oered": "offered", "oering": "offering",
}
LIGATURE_LOSS = (r"\breect(?:s|ed|ing)?\b", r"\beect(?:s|ed|ive|ively)?\b", r"\bdene[sd]?\b", r"\bdening\b", r"\bdenition(?:s)?\b", r"\bnd(?:s|ing)?\b", r"\bspecic(?:ally)?\b", r"\barticial(?:ly)?\b", r"\bidentier(?:s)?\b", r"\baliate(?:s|d)?\b", r"\bprole(?:s)?\b", r"\bverication\b", r"\bconrm(?:s|ed|ing)?\b", r"\bcongure(?:s|d|ing)?\b")
GARBLED_MARKERS = "3a bme co6 ctom moct opra pa3 py6 meponp nepe npe npo onn komh tpa bkn mnho hpиka hphka pocch tocyi tocuh o6pa yhh mhh xehe ctoh npen cyji".split()
RUSSIAN_HINTS = ("приказ", "договор", "паспорт", "персональн", "россии")
