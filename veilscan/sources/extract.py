"""Bytes of a file to (text, status, metadata, warnings), for the formats that the standard library can read.

Runs in executors on Arrow batches.  Formats whose readers are not installed give status and warnings, never an exception:
character recognition, PDF readers, converters and video tools are used where a worker has them.  Tools that take files
get a temporary one on the worker, which is removed at once.
"""

from __future__ import annotations

import contextlib
import csv
import io
import json
import os
import re
import shutil
import signal
import subprocess
import tempfile
import threading
import zipfile
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from html.parser import HTMLParser
from xml.etree import ElementTree

ENCODINGS = ("utf-8", "utf-8-sig", "cp1251", "latin-1")


@dataclass
class Extracted:
    text: str = ""
    status: str = "ok"
    metadata: dict[str, str] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)


def decode(data: bytes) -> tuple[str, str, list[str]]:
    """Text, the first encoding that fits, and a warning for each that didn't.  UTF-8 comes first, so a BOM stays."""
    warnings = []
    for encoding in ENCODINGS:
        try:
            return data.decode(encoding), encoding, warnings
        except UnicodeDecodeError:
            warnings.append(f"Encoding failed: {encoding}")
    raise AssertionError("latin-1 reads any bytes")


def plain(data: bytes, **_) -> Extracted:
    text, encoding, warnings = decode(data)
    # Line ends as text files are read: one kind.
    return Extracted(re.sub(r"\r\n?", "\n", text), metadata={"encoding": encoding, "extractor": "text"}, warnings=warnings)


def table_text(data: bytes, max_rows: int = 50_000, **_) -> Extracted:
    """CSV rows with cells joined by ` | `; the delimiter is guessed from the first 8192 characters."""
    failed = []
    for encoding in ENCODINGS:
        try:
            text = data.decode(encoding)
            dialect = csv.Sniffer().sniff(re.sub(r"\r\n?", "\n", text)[:8192], delimiters=",;\t|")
            rows, more = [], False
            for i, row in enumerate(csv.reader(io.StringIO(text, newline=""), dialect)):
                if i >= max_rows:
                    more = True
                    break
                rows.append(" | ".join(row))
            warnings = [*failed, *([f"CSV truncated at {max_rows} rows"] if more else [])]
            return Extracted("\n".join(rows), metadata={"encoding": encoding, "delimiter": dialect.delimiter, "rows_read": str(len(rows)), "extractor": "csv"}, warnings=warnings)
        except (csv.Error, ValueError) as e:
            failed.append(f"CSV parse failed with {encoding}: {type(e).__name__}")
    out = plain(data)
    out.warnings = [*failed, "CSV fallback to text", *out.warnings]
    return out


def walk(value, most: int) -> list[str]:
    """Keys and scalars of a JSON value, depth first, nulls left out; `most` of them."""
    out, todo = [], [value]
    while todo and len(out) < most:
        v = todo.pop()
        if isinstance(v, dict):
            for key, nested in reversed(v.items()):
                todo += [nested, _Key(key)]
        elif isinstance(v, list):
            todo.extend(reversed(v))
        elif v is not None:
            out.append(str(v))
    return out


class _Key(str):
    """A key on the stack of values."""


def json_text(data: bytes, max_rows: int = 50_000, **_) -> Extracted:
    failed = []
    for encoding in ENCODINGS:
        try:
            values = walk(json.loads(data.decode(encoding)), max_rows)
            return Extracted("\n".join(values), metadata={"encoding": encoding, "items_collected": str(len(values)), "extractor": "json"}, warnings=failed)
        except (ValueError, RecursionError) as e:
            failed.append(f"JSON parse failed with {encoding}: {type(e).__name__}")
    out = plain(data)
    out.warnings = [*failed, "JSON fallback to text", *out.warnings]
    return out


def parquet_text(data: bytes, max_rows: int = 50_000, **_) -> Extracted:
    import pyarrow.parquet as pq

    try:
        reader = pq.ParquetFile(io.BytesIO(data))
        names, total = reader.schema_arrow.names, reader.metadata.num_rows
        lines = [f"COLUMNS: {' | '.join(names)}"]
        for batch in reader.iter_batches(batch_size=min(max_rows, 8192) or 1):
            if len(lines) > max_rows:
                break
            columns = [c.to_pylist() for c in batch.columns]
            lines += [" | ".join("" if v is None else str(v) for v in row) for row in zip(*columns, strict=True)]
    except Exception as e:  # noqa: BLE001 - any broken file becomes a row with a warning
        return Extracted(status="error", warnings=[f"Cannot read Parquet: {e}"])
    lines = lines[: max_rows + 1]
    return Extracted("\n".join(lines), metadata={"columns": json.dumps(names), "rows_total": str(total), "rows_read": str(len(lines) - 1), "extractor": "parquet"}, warnings=["Parquet truncated by max_rows"] if total > max_rows else [])


class _Text(HTMLParser):
    """Text nodes outside script, style and noscript."""

    HIDDEN = frozenset({"script", "style", "noscript"})

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.hidden, self.nodes = 0, []

    def handle_starttag(self, tag: str, attrs) -> None:
        self.hidden += tag in self.HIDDEN

    def handle_endtag(self, tag: str) -> None:
        if tag in self.HIDDEN and self.hidden:
            self.hidden -= 1

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.nodes.append(data)


def html_nodes(text: str) -> str:
    parser = _Text()
    parser.feed(text)
    parser.close()
    return "\n".join(parser.nodes)


def html(data: bytes, **_) -> Extracted:
    out = plain(data)
    return Extracted(html_nodes(out.text), metadata={"extractor": "html", "encoding": out.metadata["encoding"]}, warnings=out.warnings)


#: Namespaces of Office files (fixed values).
WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def docx(data: bytes, **_) -> Extracted:
    """Paragraphs that are not blank, then each table's rows with cells joined by ` | `."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{WORD}body")
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as e:
        return Extracted(status="error", warnings=[f"Cannot read DOCX: {e}"])
    said = lambda node: "".join(t.text or "" for t in node.iter(f"{WORD}t"))
    lines = [t for p in body.findall(f"{WORD}p") if (t := said(p)).strip()]
    tables = body.findall(f"{WORD}tbl")
    for n, table in enumerate(tables, 1):
        lines.append(f"TABLE {n}")
        lines += [" | ".join("\n".join(said(p) for p in cell.findall(f"{WORD}p")).strip() for cell in row.findall(f"{WORD}tc")) for row in table.findall(f"{WORD}tr")]
    return Extracted("\n".join(lines), metadata={"extractor": "docx", "tables": str(len(tables))})


#: Number formats that show dates, and what is no format letter in the others (fixed values).
DATE_FORMATS = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))
NO_FORMAT = re.compile(r'"[^"]*"|\[(?!h+\]|m+\]|s+\])[^\]]*\]|[\\_*].', re.I)


def date_styles(styles: bytes) -> set[int]:
    """Cell styles of a workbook that show numbers as dates."""
    root = ElementTree.fromstring(styles)
    own = {int(f.get("numFmtId")): NO_FORMAT.sub("", (f.get("formatCode") or "").split(";")[0]) for f in root.iter(f"{SHEET}numFmt")}
    formats = [int(x.get("numFmtId") or 0) for x in root.findall(f"{SHEET}cellXfs/{SHEET}xf")]
    return {i for i, n in enumerate(formats) if (re.search("[dmhys]", own[n], re.I) if n in own else n in DATE_FORMATS)}


def cell_number(raw: str, dated: bool, since_1904: bool) -> str:
    """A number as a table shows it: a date by its style, whole numbers without a fraction."""
    try:
        x = float(raw)
        if not dated:
            return str(int(x)) if x == int(x) else str(x)
        if 0 <= x < 1:
            return str((datetime.min + timedelta(milliseconds=round(x * 86_400_000))).time())
        first = datetime(1904, 1, 1) if since_1904 else datetime(1899, 12, 31) if x < 60 else datetime(1899, 12, 30)
        return str(first + timedelta(milliseconds=round(x * 86_400_000)))
    except (ValueError, OverflowError):
        return raw


def xlsx_sheets(data: bytes, max_rows: int) -> dict[str, list[list[str]]]:
    """Sheets by name, rows of cells as text, gaps as '' and rows left out as empty ones."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = ["".join(t.text or "" for t in s.iter(f"{SHEET}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        dates = date_styles(z.read("xl/styles.xml")) if "xl/styles.xml" in names else set()
        out, book = {}, ElementTree.fromstring(z.read("xl/workbook.xml"))
        since_1904 = any(p.get("date1904") in ("1", "true") for p in book.iter(f"{SHEET}workbookPr"))
        for sheet in book.iter(f"{SHEET}sheet"):
            target = links[sheet.get(f"{REL}id")].lstrip("/")
            rows = []
            for row in ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{SHEET}row"):
                rows += [[]] * (min(int(row.get("r") or 0) - 1, max_rows) - len(rows))
                if len(rows) >= max_rows:
                    break
                cells: dict[int, str] = {}
                for i, c in enumerate(row.iter(f"{SHEET}c")):
                    letters = re.match(r"[A-Z]*", c.get("r") or "")[0]
                    at = i
                    if letters:
                        at = 0
                        for ch in letters:
                            at = at * 26 + ord(ch) - 64
                        at -= 1
                    v, kind = c.find(f"{SHEET}v"), c.get("t")
                    raw = "".join(t.text or "" for t in c.iter(f"{SHEET}t")) if kind == "inlineStr" else (v.text or "" if v is not None else "")
                    if kind == "b":
                        raw = {"1": "True", "0": "False"}.get(raw, raw)
                    elif kind in (None, "n") and raw:
                        raw = cell_number(raw, int(c.get("s") or 0) in dates, since_1904)
                    cells[at] = shared[int(raw)] if kind == "s" and raw else raw
                rows.append([cells.get(i, "") for i in range(max(cells, default=-1) + 1)])
            out[sheet.get("name")] = rows
    return out


def xlsx(data: bytes, max_rows: int = 50_000, **_) -> Extracted:
    try:
        sheets = xlsx_sheets(data, max_rows)
    except (zipfile.BadZipFile, KeyError, ValueError, IndexError, ElementTree.ParseError) as e:
        return Extracted(status="error", warnings=[f"Cannot read Excel: {e}"])
    return _sheet_lines(sheets)


def _sheet_lines(sheets: dict[str, list[list[str]]]) -> Extracted:
    lines, short = [], set()
    for name, rows in sheets.items():
        lines.append(f"SHEET: {name}")
        for row in rows:
            cells = [c for c in row if c.strip() and c.strip().lower() != "nan"]
            short.update(c for c in cells if len(c) < 80)
            if cells:
                lines.append(" | ".join(cells))
    return Extracted("\n".join(lines), metadata={"extractor": "excel", "sheets": json.dumps(list(sheets)), "short_cells": json.dumps(sorted(short)[:200], ensure_ascii=False)})


def old_sheets(data: bytes, max_rows: int, dtype=None) -> dict:
    """Sheets of a workbook of the old format as pandas frames without header; needs pandas' reader for it."""
    import pandas as pd

    found = pd.read_excel(io.BytesIO(data), sheet_name=None, header=None, dtype=dtype, nrows=max_rows)
    return {str(name): frame for name, frame in found.items()}


def xls(data: bytes, max_rows: int = 50_000, **_) -> Extracted:
    try:
        sheets = old_sheets(data, max_rows)
    except ImportError as e:
        return Extracted(status="skipped", warnings=[f"Excel reader unavailable: {e}"])
    except Exception as e:  # noqa: BLE001 - any broken file becomes a row with a warning
        return Extracted(status="error", warnings=[f"Cannot read Excel: {e}"])
    return _sheet_lines({name: frame.astype(str).to_numpy().tolist() for name, frame in sheets.items()})


#: Tables that are analysed by row and column, and cells that count as empty in Excel files (fixed values).
TABLES = (".csv", ".xlsx", ".xls", ".parquet")
NO_VALUE = frozenset(("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"))


def csv_frame(data: bytes, max_rows: int):
    """A CSV file as a pandas frame of strings: separator guessed, then four separators, in each of the encodings."""
    import pandas as pd

    failed = []
    ways = [(encoding, None) for encoding in ENCODINGS] + [(encoding, sep) for encoding in ENCODINGS for sep in (",", ";", "\t", "|")]
    for encoding, sep in ways:
        try:
            return pd.read_csv(io.BytesIO(data), sep=sep, engine="python" if sep is None else None, dtype=str, keep_default_na=False, nrows=max_rows, encoding=encoding)
        except Exception as e:  # noqa: BLE001 - the next way
            if sep is None:
                failed.append(f"{encoding}: {type(e).__name__}")
    raise ValueError("; ".join(failed))


def parquet_frame(data: bytes, max_rows: int):
    """The first max_rows rows of a Parquet file as a pandas frame."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    reader, batches, n = pq.ParquetFile(io.BytesIO(data)), [], 0
    for batch in reader.iter_batches(batch_size=max(1, min(max_rows, 8192))):
        if n >= max_rows:
            break
        batches.append(batch)
        n += batch.num_rows
    return pa.Table.from_batches(batches, reader.schema_arrow).slice(0, max_rows).to_pandas()


def table_frames(data: bytes, extension: str, max_rows: int = 50_000) -> dict[str, tuple[list[str], list[list[str]]]]:
    """Sheets by name: names of the columns, and at most max_rows rows of values, '' where there is none.  Excel sheets have no header."""
    if extension == ".xls":
        return {name: ([str(c) for c in frame.columns], frame.fillna("").astype(str).to_numpy().tolist()) for name, frame in old_sheets(data, max_rows, str).items()}
    if extension == ".xlsx":
        out = {}
        for name, rows in xlsx_sheets(data, max_rows).items():
            rows = [["" if v in NO_VALUE else v for v in row] for row in rows]
            while rows and not any(rows[-1]):
                rows.pop()
            width = max(map(len, rows), default=0)
            out[name] = [str(i) for i in range(width)], [row + [""] * (width - len(row)) for row in rows]
        return out
    frame = csv_frame(data, max_rows) if extension == ".csv" else parquet_frame(data, max_rows)
    frame = frame.astype(object).where(frame.notna(), "").astype(str)
    return {extension[1:]: ([str(c) for c in frame.columns], frame.to_numpy().tolist())}


#: Groups of RTF that hold no text (fixed values).
RTF_SILENT = frozenset("fonttbl colortbl stylesheet info pict header footer generator themedata".split())


def rtf(data: bytes, **_) -> Extracted:
    """Text of an RTF file: control words dropped, \\par and \\line as line ends, \\'hh by the code page, \\uN by code point."""
    source = data.decode("utf-8", "ignore")
    page = re.search(r"\\ansicpg(\d+)", source)
    page = f"cp{page[1]}" if page else "cp1252"
    out, stack, silent, skip = [], [], False, 0
    for m in re.finditer(r"\\'([0-9a-fA-F]{2})|\\u(-?\d+) ?|\\([a-z]+)(-?\d+)? ?|\\(.)|([{}])|([^\\{}\r\n]+)|[\r\n]+", source, re.S):
        code, point, word, _number, sign, brace, text = m.groups()
        if brace == "{":
            stack.append(silent)
        elif brace == "}":
            silent = stack.pop() if stack else False
        elif word in RTF_SILENT or sign == "*":
            silent = True
        elif silent:
            continue
        elif code and skip:
            skip -= 1
        elif code:
            out.append(bytes([int(code, 16)]).decode(page, "replace"))
        elif point:
            out.append(chr(int(point) % 65536))
            skip = 1
        elif word in ("par", "line", "row"):
            out.append("\n")
        elif word in ("tab", "cell"):
            out.append("\t")
        elif sign:
            out.append(" " if sign == "~" else sign if sign in "\\{}" else "")
        elif text:
            out.append(text[skip:])
            skip = 0
    return Extracted("".join(out), metadata={"extractor": "rtf"})


def cyrillic_letters(text: str) -> int:
    return len(re.findall("[А-Яа-яЁё]", text))


def repair_mojibake(text: str) -> str:
    """Text whose bytes were read as Latin-1 though they were cp1251: read again where that gives more Cyrillic letters."""

    def again(m: re.Match) -> str:
        try:
            return m[0].encode("latin-1").decode("cp1251")
        except UnicodeDecodeError:
            return m[0]

    fixed = re.sub("[\u0000-ÿ]+", again, text)
    return fixed if cyrillic_letters(fixed) > cyrillic_letters(text) else text


@contextlib.contextmanager
def time_limit(seconds: float):
    """TimeoutError in the block after so many seconds (0: never); only in a main thread, as Python workers' are."""
    if seconds <= 0 or threading.current_thread() is not threading.main_thread():
        yield
        return

    def over(*_):
        raise TimeoutError(f"file processing timed out after {seconds:g}s")

    before = signal.signal(signal.SIGALRM, over)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


@contextlib.contextmanager
def as_file(data: bytes, extension: str):
    """The path of a temporary file with these bytes."""
    with tempfile.TemporaryDirectory(prefix="veilscan-file-") as folder:
        path = os.path.join(folder, f"file{extension}")
        with open(path, "wb") as f:
            f.write(data)
        yield path


#: Languages of recognition, in order; of frames of videos, and their settings (fixed values).
LANGUAGES, FRAME_LANGUAGES, FRAME_SETTINGS = ("rus+eng", "rus", "eng"), ("rus+eng", "eng"), ("--oem 3 --psm 6",)


def recognised(engine, picture, languages: tuple[str, ...] = LANGUAGES) -> tuple[str, str, list[str]]:
    """Text of a picture in the first language that the engine knows, else in its own; the language; warnings."""
    warnings = []
    for language in languages:
        try:
            return engine.image_to_string(picture, lang=language) or "", language, warnings
        except Exception as e:  # noqa: BLE001 - the next language
            warnings.append(f"OCR failed for {language}: {type(e).__name__}")
    return engine.image_to_string(picture) or "", "default", [*warnings, "OCR used default language"]


def image(data: bytes, use_ocr: bool = False, **_) -> Extracted:
    """Recognised text of a picture; without recognition an empty text that is in order."""
    out = Extracted(metadata={"extractor": "image", "ocr_used": "false"})
    if not use_ocr:
        out.warnings.append("OCR disabled")
        return out
    try:
        import pytesseract
        from PIL import Image
    except ImportError as e:
        out.warnings.append(f"OCR unavailable: {type(e).__name__}")
        return out
    try:
        with Image.open(io.BytesIO(data)) as picture:
            out.metadata |= {"image_size": str(picture.size), "image_mode": str(picture.mode)}
            out.text, language, out.warnings = recognised(pytesseract, picture)
        out.metadata |= {"ocr_used": "true", "ocr_language": language}
    except Exception as e:  # noqa: BLE001
        out.warnings.append(f"OCR failed: {e}")
    return out


def _pages_by(module: str, data: bytes) -> list[str]:
    """Text of each page, by an installed reader."""
    if module == "pdfplumber":
        import pdfplumber

        with pdfplumber.open(io.BytesIO(data)) as document:
            return [p.extract_text() or "" for p in document.pages]
    from pypdf import PdfReader

    return [p.extract_text() or "" for p in PdfReader(io.BytesIO(data)).pages]


def _scanned_pages(data: bytes) -> tuple[list[str], list[str]]:
    """Recognised text of each page and warnings; a page that fails is left out."""
    import pypdfium2
    import pytesseract

    texts, warnings = [], []
    document = pypdfium2.PdfDocument(data)
    for k in range(len(document)):
        try:
            text, language, _ = recognised(pytesseract, document[k].render(scale=2.5).to_pil(), LANGUAGES[:2])
            texts.append(text)
            if language != LANGUAGES[0]:
                warnings.append(f"Page {k + 1}: {LANGUAGES[0]} OCR failed, retried with {language}")
        except Exception as e:  # noqa: BLE001 - the next page
            warnings.append(f"Page {k + 1}: OCR failed: {e}")
    return texts, warnings


def pdf(data: bytes, use_ocr: bool = False, **_) -> Extracted:
    """Text of the first installed reader that finds any, then of recognition; else an empty text marked as a possible scan."""
    warnings, extractor = [], "none"
    for module in ("pdfplumber", "pypdf"):
        try:
            extractor = module
            pages = _pages_by(module, data)
            if any(map(str.strip, pages)):
                return Extracted("\n\n".join(pages), metadata={"extractor": module, "pages": str(len(pages))}, warnings=warnings)
        except ImportError as e:
            warnings.append(f"{module} unavailable: {type(e).__name__}")
        except Exception as e:  # noqa: BLE001
            warnings.append(f"{module} failed: {e}")
    if use_ocr:
        try:
            pages, said = _scanned_pages(data)
            warnings += said
            if any(map(str.strip, pages)):
                return Extracted("\n\n".join(pages), metadata={"extractor": "pdf-ocr-tesseract", "pages": str(len(pages)), "ocr_used": "true", "ocr_language": LANGUAGES[0]}, warnings=warnings)
            warnings.append("PDF OCR returned empty text")
        except ImportError as e:
            warnings.append(f"PDF OCR dependencies unavailable: {type(e).__name__}")
        except Exception as e:  # noqa: BLE001
            warnings.append(f"PDF OCR failed: {e}")
    return Extracted(metadata={"extractor": extractor, "possible_scanned_pdf": "true"}, warnings=[*warnings, "PDF text layer is empty; possible scanned PDF"])


def doc(data: bytes, **_) -> Extracted:
    """Text of a legacy Word file by textract, else by textutil with mojibake repaired; without either it is skipped."""
    warnings = []
    with as_file(data, ".doc") as path:
        try:
            import textract

            return Extracted(textract.process(path).decode("utf-8", "ignore"), metadata={"extractor": "textract-doc"})
        except ImportError as e:
            warnings.append(f"textract unavailable: {type(e).__name__}")
        except Exception as e:  # noqa: BLE001
            warnings.append(f"textract failed: {e}")
        try:
            done = subprocess.run(["textutil", "-convert", "txt", "-stdout", path], check=False, capture_output=True, timeout=120)
            text = repair_mojibake(done.stdout.decode("utf-8", "replace"))
            if done.returncode == 0 and text.strip():
                return Extracted(text, metadata={"extractor": "textutil-doc"}, warnings=warnings)
            warnings.append(f"textutil returned no text: {done.stderr.decode('utf-8', 'replace').strip() or f'exit_code={done.returncode}'}")
        except FileNotFoundError:
            warnings.append("textutil unavailable")
        except (OSError, subprocess.SubprocessError) as e:
            warnings.append(f"textutil failed: {e}")
    return Extracted(status="skipped", warnings=[f"DOC extraction unavailable: {'; '.join(warnings)}"])


_converters: list = []


def converted(data: bytes, extension: str) -> Extracted:
    """Text of an office file or page by the universal converter, which a worker makes once; skipped where there is none."""
    try:
        if not _converters:
            os.environ.setdefault("PYTORCH_ENABLE_MPS_FALLBACK", "1")
            from docling.document_converter import DocumentConverter

            _converters.append(DocumentConverter())
    except Exception as e:  # noqa: BLE001 - whatever keeps the library from loading
        return Extracted(status="skipped", warnings=[f"Docling unavailable: {type(e).__name__}"])
    try:
        with as_file(data, extension) as path:
            document = _converters[0].convert(path).document
        said = getattr(document, "export_to_markdown", None) or getattr(document, "export_to_text", lambda: "")
        if text := said():
            return Extracted(text, metadata={"docling_used": "true", "extractor": "docling"})
        return Extracted(status="skipped", metadata={"docling_used": "true"}, warnings=["Docling returned empty text"])
    except Exception as e:  # noqa: BLE001
        return Extracted(status="skipped", metadata={"docling_used": "false"}, warnings=[f"Docling failed: {e}"])


#: Formats that the universal converter is asked for first (fixed values).
CONVERTED = frozenset((".docx", ".doc", ".rtf", ".xlsx", ".xls", ".html", ".htm"))


def video(data: bytes, use_ocr: bool = False, extension: str = ".mp4", **_) -> Extracted:
    """Recognised text of a video's frames; without tools or recognition an empty text that is in order."""
    out = Extracted(metadata={"extractor": "video", "ocr_used": "false"})
    if not use_ocr:
        out.warnings.append("Video OCR disabled")
    elif not shutil.which("ffmpeg"):
        out.warnings.append("ffmpeg unavailable for video frame extraction")
    else:
        try:
            from .frames import read_frames
        except ImportError as e:
            out.warnings.append(f"OCR unavailable: {type(e).__name__}")
            return out
        try:
            with as_file(data, extension) as path:
                read_frames(path, out)
        except Exception as e:  # noqa: BLE001
            out.warnings.append(f"Video OCR failed: {e}")
    return out


READERS = {
    ".txt": plain, ".md": plain, ".log": plain, ".csv": table_text, ".json": json_text, ".parquet": parquet_text, ".docx": docx, ".rtf": rtf, ".xlsx": xlsx, ".xls": xls, ".doc": doc, ".pdf": pdf, ".html": html, ".htm": html,
    **dict.fromkeys((".png", ".jpg", ".jpeg", ".tif", ".tiff", ".gif"), image), **dict.fromkeys((".mp4", ".avi", ".mov", ".mkv", ".webm", ".mpeg", ".mpg"), video),
}


def extract(data: bytes, extension: str, use_ocr: bool = False, max_rows: int = 50_000, timeout: float = 0) -> Extracted:
    """Text of a file; what fails, or takes longer than timeout seconds (0: no limit), is a status and a warning."""
    reader = READERS.get(extension)
    if reader is None:
        return Extracted(status="skipped", warnings=[f"Unsupported extension: {extension}"])
    try:
        with time_limit(timeout):
            before = []
            if extension in CONVERTED:
                whole = converted(data, extension)
                if whole.status == "ok" and whole.text.strip():
                    return whole
                before = [f"docling: {w}" for w in whole.warnings]
            out = reader(data, use_ocr=use_ocr, max_rows=max_rows, extension=extension)
            out.warnings = [*before, *out.warnings]
            return out
    except TimeoutError as e:
        return Extracted(status="error", warnings=[str(e)])
    except Exception as e:  # noqa: BLE001 - one broken file is one row with status error
        return Extracted(status="error", warnings=[f"{type(e).__name__}: {e}"])
