"""Sources, extraction, routing, tables, sinks, the whole run and the stream, on small files."""

from __future__ import annotations

import io
import json
import sys
import types
import zipfile

from pyspark.sql import functions as F

from veilscan.operators import quality, routing, tables, video
from veilscan.plans import cli, pipeline
from veilscan.sources import extract as X
from veilscan.sources import files, sinks
from veilscan.streaming.scan import score_stream, text_stream


def office(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in parts.items():
            z.writestr(name, body)
    return out.getvalue()


def docx() -> bytes:
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    return office({"word/document.xml": f"<w:document {w}><w:body><w:p><w:r><w:t>Hello</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>"})


def xlsx() -> bytes:
    m, r = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    return office({
        "xl/workbook.xml": f'<workbook xmlns="{m}" xmlns:r="{r}"><sheets><sheet name="S1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/sharedStrings.xml": f'<sst xmlns="{m}"><si><t>name</t></si></sst>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{m}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>5</v></c></row><row r="2"><c r="A2" t="inlineStr"><is><t>nan</t></is></c></row></sheetData></worksheet>',
    })


def test_extractors():
    assert X.extract("при".encode("cp1251"), ".txt").text == "при" and X.extract(b"\xef\xbb\xbfa\r\nb", ".txt").text == "﻿a\nb"
    assert X.extract(b"a;b\n1;2\n3;4\n", ".csv", max_rows=2).text == "a | b\n1 | 2"
    assert X.extract(b'{"a": [1, {"b": null, "c": true}], "d": "x"}', ".json").text == "a\n1\nb\nc\nTrue\nd\nx"
    assert X.extract(b"{broken", ".json").warnings[-1] == "JSON fallback to text"
    assert X.extract(docx(), ".docx").text == "Hello\nTABLE 1\na | b"
    got = X.extract(xlsx(), ".xlsx")
    assert got.text == "SHEET: S1\nname | 5" and json.loads(got.metadata["short_cells"]) == ["5", "name"]
    assert X.extract(b"{" + rb"\rtf1\ansi\ansicpg1251{\fonttbl x;}\'cf\'f0\par" + b"\\" + b"u1080?}", ".rtf").text == "Пр\nи"
    assert X.extract(b"<p>a<script>x</script><b>b</b></p>", ".html").text == "a\nb"
    assert X.extract(b"no zip", ".docx").status == "error" and X.extract(b"x", ".exe").status == "skipped" and X.extract(b"x", ".doc").status == "skipped"
    assert X.extract(b"x", ".png").status == "ok" and X.extract(b"x", ".pdf").metadata["possible_scanned_pdf"] == "true"
    assert X.repair_mojibake("Ïðèâåò") == "Привет" and X.repair_mojibake("plain") == "plain"


def tree(tmp_path):
    root = tmp_path / "in"
    (root / "личное").mkdir(parents=True)
    (root / "личное" / "a.txt").write_text("Иванов Иван Иванович, паспорт серия 4510 номер 123456, выдан ОВД. тел. +7 (999) 123-45-67", encoding="utf-8")
    (root / "b.csv").write_text("name,phone\nx,+7 999 123-45-67\n", encoding="utf-8")
    (root / "~$c.docx").write_bytes(b"lock")
    (root / "d.exe").write_bytes(b"x")
    (root / "noext").write_bytes(b"x")
    (root / "e.docx").write_bytes(b"broken")
    return root


def test_scan_and_run(spark, tmp_path):
    root, out = tree(tmp_path), tmp_path / "out"
    got = {r.relative_path: (r.status, r.error, r.extension) for r in files.scan(spark, str(root)).collect()}
    assert got == {"личное/a.txt": ("pending", None, ".txt"), "b.csv": ("pending", None, ".csv"), "e.docx": ("pending", None, ".docx"), "~$c.docx": ("skipped", "Temporary Office lock file", ".docx"), "d.exe": ("skipped", "Unsupported extension: .exe", ".exe"), "noext": ("skipped", "Unsupported extension: <none>", "")}
    assert {r.status for r in files.scan(spark, str(root), limit_mb=0).where("extension = '.csv'").collect()} == {"skipped"}
    assert cli.main(["--input-dir", str(root), "--output-dir", str(out)]) == 0
    report = json.loads((out / "reports/final_report.json").read_text(encoding="utf-8"))
    assert report["stats"] == {"total_files": 6, "processed_files": 2, "skipped_files": 3, "error_files": 1}
    assert [i["relative_path"] for i in report["items"]] == ["личное/a.txt"] and (out / "leaked_paths.txt").read_text(encoding="utf-8") == "/личное/a.txt\n"
    text = (out / "reports/final_report.csv").read_bytes()
    assert text.startswith(b"\xef\xbb\xbf") and text.count(b"\r\n") == 2
    assert "личное/a.txt" in (out / "reports/final_report.md").read_text(encoding="utf-8")
    assert sinks.load_items(spark, str(out / "reports/final_report.json")).count() == 1
    assert cli.main(["--input-dir", str(root / "gone"), "--output-dir", str(out)]) == 2
    wanted = tmp_path / "list.txt"
    wanted.write_text("# no\n/b.csv\nmissing.txt\n", encoding="utf-8")
    assert cli.main(["--input-dir", str(root), "--output-dir", str(out), "--include-list", str(wanted)]) == 0
    assert json.loads((out / "reports/final_report.json").read_text(encoding="utf-8"))["stats"] == {"total_files": 2, "processed_files": 1, "skipped_files": 1, "error_files": 0}


def test_every_file_is_a_row(spark, tmp_path):
    """Hidden and empty files, odd names, folders that are hidden: each has its row, and pending ones are read."""
    root = tmp_path / "in"
    (root / ".git" / "_x").mkdir(parents=True)
    (root / "a b").mkdir()
    names = {".hidden.txt": "a@b.ru", "_under.txt": "a@b.ru", "empty.txt": "", "a b/[odd] {x}*?; isDirectory.txt": "a@b.ru", ".git/_x/deep.log": "a@b.ru", "_k=v.txt": "a@b.ru", ".txt": "x", "UPPER.TXT": "a@b.ru", "~$lock.txt": "x", ".env": "x"}
    for name, text in names.items():
        (root / name).write_text(text, encoding="utf-8")
    rows = {r.relative_path: r for r in files.scan(spark, str(root)).collect()}
    assert set(rows) == set(names)
    assert {n for n, r in rows.items() if r.status == "skipped"} == {".txt", "~$lock.txt", ".env"} and rows["empty.txt"].size_bytes == 0
    scored, outcomes, _ = pipeline.full(spark, str(root))
    assert {r.relative_path: bool(r.categories) for r in scored.collect()} == {n: bool(names[n]) for n, r in rows.items() if r.status == "pending"}
    assert outcomes.count() == len(names)
    wanted = spark.createDataFrame([("a b/[odd] {x}*?; isDirectory.txt",), ("_under.txt",), ("gone.txt",)], "relative_path string")
    scored, outcomes, lost = pipeline.full(spark, str(root), wanted)
    assert {r.relative_path for r in scored.collect()} == {"a b/[odd] {x}*?; isDirectory.txt", "_under.txt"} and outcomes.count() == 2 and lost.count() == 1


def test_skipped_files_stay_closed(spark, tmp_path):
    """A skipped file may be over the reader's own limit."""
    root = tmp_path / "in"
    root.mkdir()
    (root / "big.exe").write_bytes(b"x" * 1000)
    (root / "big.txt").write_bytes(b"x" * 1000)
    (root / "small.txt").write_bytes(b"a@b.ru")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "200")
    try:
        scored, outcomes, _ = pipeline.full(spark, str(root), limit_mb=0.0005)
        assert [r.relative_path for r in scored.collect()] == ["small.txt"]
        assert sorted(r.bucket for r in outcomes.collect()) == ["processed", "skipped", "skipped"]
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_stuck_file_is_an_error(monkeypatch):
    def stuck(data, **_):
        while True:
            pass

    monkeypatch.setitem(X.READERS, ".txt", stuck)
    got = X.extract(b"x", ".txt", timeout=0.2)
    assert got.status == "error" and got.warnings == ["file processing timed out after 0.2s"]
    monkeypatch.setitem(X.READERS, ".txt", X.plain)
    assert X.extract(b"x", ".txt", timeout=0.2).text == "x"


def test_files_of_each_row_and_both_passes(spark, tmp_path):
    root, out = tree(tmp_path), tmp_path / "run"
    assert cli.main(["--input-dir", str(root), "--run-dir", str(out), "--file-timeout", "60", "--pdf-workers", "2"]) == 0
    first = json.loads((out / "parsed/reports/final_report.json").read_text(encoding="utf-8"))
    item = first["items"][0]
    assert "+7 (999) 123-45-67" in open(item["extracted_text_path"], encoding="utf-8").read()
    found = json.load(open(item["pii_findings_path"], encoding="utf-8"))
    assert found["relative_path"] == "личное/a.txt" and found["categories"]["phone"]["count"] == 1 and found["features"]["unique_persons"] == 1
    final = json.loads((out / "final/reports/final_report.json").read_text(encoding="utf-8"))
    assert [i["relative_path"] for i in final["items"]] == ["личное/a.txt"] and final["stats"]["processed_files"] == 2
    assert (out / "final/leaked_paths.txt").read_text(encoding="utf-8") == "/личное/a.txt\n"
    # The second pass alone, over the files of texts.
    assert cli.main(["--input-dir", str(root), "--output-dir", str(out / "again"), "--texts-dir", str(out / "parsed/extracted_texts")]) == 0
    assert (out / "again/leaked_paths.txt").read_text(encoding="utf-8") == "/личное/a.txt\n"
    assert cli.main(["--input-dir", str(root), "--output-dir", str(out / "tables"), "--tables-only"]) == 0
    assert not (out / "tables/extracted_texts").exists() and spark.read.parquet(str(out / "tables/tables/extracted_texts")).count() == 2
    assert cli.main(["--input-dir", str(root / "b.csv"), "--output-dir", str(out)]) == 2


class _Module(types.ModuleType):
    """A stand-in for a library that isn't installed here."""

    def __init__(self, name, **parts):
        super().__init__(name)
        self.__dict__.update(parts)


class _Picture:
    size, mode = (10, 20), "L"

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False


def _ocr(known):
    def image_to_string(picture, lang=None, config=""):
        if lang is not None and lang not in known:
            raise RuntimeError(lang)
        return f"text in {lang}"

    return _Module("pytesseract", image_to_string=image_to_string)


def test_recognition_where_it_is_installed(monkeypatch):
    monkeypatch.setitem(sys.modules, "PIL", _Module("PIL", Image=_Module("PIL.Image", open=lambda data: _Picture())))
    for known, text, language, warned in ((("rus+eng",), "text in rus+eng", "rus+eng", 0), (("eng",), "text in eng", "eng", 2), ((), "text in None", "default", 4)):
        monkeypatch.setitem(sys.modules, "pytesseract", _ocr(known))
        got = X.extract(b"x", ".png", use_ocr=True)
        assert (got.text, got.metadata["ocr_language"], got.metadata["ocr_used"], len(got.warnings)) == (text, language, "true", warned)
    assert X.extract(b"x", ".png").warnings == ["OCR disabled"]
    monkeypatch.setitem(sys.modules, "pytesseract", None)
    assert X.extract(b"x", ".png", use_ocr=True).warnings[0].startswith("OCR unavailable")


def test_pdf_readers_in_turn(monkeypatch):
    class Page:
        def __init__(self, text):
            self.text = text

        def extract_text(self):
            return self.text

        def render(self, scale):
            return types.SimpleNamespace(to_pil=lambda: self.text)

    class Book:
        def __init__(self, pages):
            self.pages = [Page(p) for p in pages]

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

        def __len__(self):
            return len(self.pages)

        def __getitem__(self, k):
            return self.pages[k]

    monkeypatch.setitem(sys.modules, "pdfplumber", _Module("pdfplumber", open=lambda data: Book(["one", "two"])))
    got = X.extract(b"x", ".pdf")
    assert (got.text, got.metadata) == ("one\n\ntwo", {"extractor": "pdfplumber", "pages": "2"})
    monkeypatch.setitem(sys.modules, "pdfplumber", _Module("pdfplumber", open=lambda data: Book([" "])))
    monkeypatch.setitem(sys.modules, "pypdf", _Module("pypdf", PdfReader=lambda data: Book(["by pypdf"])))
    assert X.extract(b"x", ".pdf").metadata["extractor"] == "pypdf"
    monkeypatch.setitem(sys.modules, "pypdf", _Module("pypdf", PdfReader=lambda data: Book([""])))
    got = X.extract(b"x", ".pdf", use_ocr=False)
    assert got.text == "" and got.metadata["possible_scanned_pdf"] == "true"
    monkeypatch.setitem(sys.modules, "pypdfium2", _Module("pypdfium2", PdfDocument=lambda data: Book(["a", "b"])))
    monkeypatch.setitem(sys.modules, "pytesseract", _ocr(("rus",)))
    got = X.extract(b"x", ".pdf", use_ocr=True)
    assert got.text == "text in rus\n\ntext in rus" and got.metadata["ocr_used"] == "true" and len(got.warnings) == 2


def test_converter_and_old_formats(monkeypatch):
    document = types.SimpleNamespace(export_to_markdown=lambda: "# by converter")
    made = []

    class Converter:
        def __init__(self):
            made.append(self)

        def convert(self, path):
            assert open(path, "rb").read() in (b"x", b"<p>y</p>")
            return types.SimpleNamespace(document=document)

    monkeypatch.setattr(X, "_converters", [])
    assert X.extract(b"<p>y</p>", ".html").warnings[0].startswith("docling: Docling unavailable")
    monkeypatch.setitem(sys.modules, "docling", _Module("docling"))
    monkeypatch.setitem(sys.modules, "docling.document_converter", _Module("docling.document_converter", DocumentConverter=Converter))
    assert X.extract(b"x", ".docx").text == "# by converter" == X.extract(b"<p>y</p>", ".html").text and len(made) == 1
    assert X.extract(b"x", ".txt").text == "x"
    document.export_to_markdown = lambda: ""
    assert X.extract(b"<p>y</p>", ".html").text == "y"
    monkeypatch.setitem(sys.modules, "textract", _Module("textract", process=lambda path: "слово".encode()))
    assert (X.extract(b"x", ".doc").text, X.extract(b"x", ".doc").metadata["extractor"]) == ("слово", "textract-doc")
    monkeypatch.setitem(sys.modules, "textract", None)
    monkeypatch.setattr(X.subprocess, "run", lambda *a, **k: types.SimpleNamespace(returncode=0, stdout="Ïðèâåò".encode(), stderr=b""))
    assert X.extract(b"x", ".doc").text == "Привет"
    import pandas as pd

    monkeypatch.setattr(pd, "read_excel", lambda *a, **k: {"S": pd.DataFrame([["a", None], ["b", "c"]])})
    assert X.extract(b"x", ".xls").text == "SHEET: S\na | None\nb | c" and X.table_frames(b"x", ".xls") == {"S": (["0", "1"], [["a", ""], ["b", "c"]])}


def test_frames_of_videos(monkeypatch, tmp_path):
    """Frames are grabbed, scored, cut into regions and read; the best readings make the text."""

    class Frame:
        def __init__(self, width=400, height=200):
            self.width, self.height, self.size = width, height, (width, height)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

        def convert(self, mode):
            return self

        def crop(self, box):
            return Frame(box[2] - box[0], box[3] - box[1])

        def resize(self, size):
            return Frame(*size)

        def filter(self, kind):
            return self

        def histogram(self):
            return [1] * 256

        def enhance(self, factor):
            return self

    same = lambda picture: picture
    pil = _Module("PIL", Image=_Module("Image", open=lambda path: Frame()), ImageEnhance=_Module("E", Contrast=same, Sharpness=same), ImageFilter=_Module("F", FIND_EDGES=1), ImageOps=_Module("O", grayscale=same))
    said = lambda picture, lang=None, config="": f"Frame of width {picture.width} read in {lang} letters"
    monkeypatch.setitem(sys.modules, "PIL", pil)
    monkeypatch.setitem(sys.modules, "pytesseract", _Module("pytesseract", image_to_string=said))
    monkeypatch.setitem(sys.modules, "cv2", None)
    monkeypatch.delitem(sys.modules, "veilscan.sources.frames", raising=False)
    monkeypatch.setattr(X.shutil, "which", lambda name: f"/bin/{name}")

    def tool(command, **_):
        if command[0] == "ffprobe":
            return types.SimpleNamespace(returncode=0, stdout="2.6\n", stderr="")
        if command[-1].endswith("3.png"):
            return types.SimpleNamespace(returncode=1, stdout="", stderr="no frame")
        open(command[-1], "wb").close()
        return types.SimpleNamespace(returncode=0, stdout="", stderr="")

    monkeypatch.setattr(X.subprocess, "run", tool)
    got = X.extract(b"video", ".mp4", use_ocr=True)
    assert got.status == "ok" and got.metadata["frames_extracted"] == "4" and got.metadata["frames_ocr_attempted"] == "4" and got.warnings == ["frame 3: no frame"]
    assert got.text.startswith("[frame_0001; rus+eng; full/enhanced_gray --oem 3 --psm 6; score=") and got.metadata["ocr_used"] == "true" and got.text.count("[frame_") <= 5
    monkeypatch.setattr(X.shutil, "which", lambda name: None)
    assert X.extract(b"video", ".mp4", use_ocr=True).warnings == ["ffmpeg unavailable for video frame extraction"] and X.extract(b"video", ".mp4").warnings == ["Video OCR disabled"]
    monkeypatch.delitem(sys.modules, "veilscan.sources.frames", raising=False)


def test_boxes_and_snippets_are_alike_on_both_sides(spark):
    """Spark's versions and those for one frame or video agree."""
    shapes = [(w, h, d) for w in (50, 81, 300, 1000) for h in (60, 100, 299, 900) for d in (None, (-5, 3, w + 9, h - 1), (0, 0, w, h))]
    for w, h, d in shapes[::5]:
        box = F.array(*map(F.lit, d)) if d else None
        got = spark.range(1).select(video.regions(F.lit(w), F.lit(h), box).alias("x")).first().x
        assert [(b.name, tuple(b.box)) for b in got] == video.bands(w, h, d), (w, h, d)
    texts = ["short", "A longer text of words number 1", "a LONGER text, of words number 1!", "another text of 12 words\nand lines 77", "*** ??? !!! ~~~ ^^^ &&& ((( )))", "\u0130stanbul words and digits 123 here"]
    assert [r.s for r in spark.createDataFrame([(t,) for t in texts], "t string").select(quality.ocr_score(F.col("t")).alias("s")).collect()] == [video.text_score(t) for t in texts]


def test_full_pass_analyses_tables(spark, tmp_path):
    """Tables of every kind reach the row, column and combination rules by way of scanned files."""
    import pandas as pd

    root, out = tmp_path / "in", tmp_path / "out"
    root.mkdir()
    people = [("Иванов Иван Иванович", f"паспорт: 4510 1{i:02d}456") for i in range(30)]
    (root / "a.csv").write_bytes("\n".join(["person;doc", *(";".join(p) for p in people)]).encode("cp1251"))
    pd.DataFrame(people, columns=["person", "doc"]).to_parquet(root / "B.PARQUET")
    m, r = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    row = lambda i, values: f'<row r="{i}">' + "".join(f'<c r="{c}{i}" t="inlineStr"><is><t>{v}</t></is></c>' for c, v in zip("AB", values, strict=True)) + "</row>"
    sheets = {1: "".join(row(i, p) for i, p in enumerate(people, 1)), 2: row(3, ("x", "y")) + '<row r="4"><c r="A4" s="1"><v>32874</v></c><c r="B4" t="b"><v>1</v></c></row>'}
    (root / "c.xlsx").write_bytes(office({
        "xl/workbook.xml": f'<workbook xmlns="{m}" xmlns:r="{r}"><sheets>' + "".join(f'<sheet name="S{k}" sheetId="{k}" r:id="rId{k}"/>' for k in sheets) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>' for k in sheets) + "</Relationships>",
        "xl/styles.xml": f'<styleSheet xmlns="{m}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        **{f"xl/worksheets/sheet{k}.xml": f'<worksheet xmlns="{m}"><sheetData>{body}</sheetData></worksheet>' for k, body in sheets.items()},
    }))
    (root / "d.csv").write_text("person,phone\n", encoding="utf-8")
    (root / "e.csv").write_bytes(b"\n")
    (root / "f.txt").write_text("no table", encoding="utf-8")
    assert X.table_frames((root / "c.xlsx").read_bytes(), ".xlsx")["S2"] == (["0", "1"], [["", ""], ["", ""], ["x", "y"], ["1990-01-01 00:00:00", "True"]])
    got = {x.relative_path: x for x in pipeline.full(spark, str(root))[0].collect()}
    for name, sheets, n in (("a.csv", ["csv"], 30), ("B.PARQUET", ["parquet"], 30), ("c.xlsx", ["S1", "S2"], 34)):
        a = got[name].table_analysis
        assert (a.status, a.sheets, a.rows_analyzed) == ("ok", sheets, n), name
        assert a.rows_with_sensitive_combo == a.row_combinations["full_name+passport_rf"] > 20 and "full_name" in a.pii_columns and got[name].document_type == "таблица с идентификаторами" and got[name].massiveness_score >= 8
    assert (got["d.csv"].table_analysis.status, got["d.csv"].table_analysis.rows_analyzed, got["d.csv"].table_analysis.columns_total) == ("ok", 0, 2)
    assert got["e.csv"].table_analysis.status == "error" and got["e.csv"].table_analysis.warnings[0].startswith("table read failed")
    assert got["f.txt"].table_analysis is None
    pipeline.run(spark, str(root), str(out))
    assert {"/a.csv", "/B.PARQUET", "/c.xlsx"} <= set((out / "leaked_paths.txt").read_text(encoding="utf-8").split("\n"))


def test_text_only_run(spark, tmp_path):
    root, texts = tree(tmp_path), tmp_path / "texts"
    texts.mkdir()
    ident = {r.relative_path: r.id for r in files.scan(spark, str(root)).select("relative_path", sinks.file_id(F.col("relative_path")).alias("id")).collect()}
    (texts / f"{ident['b.csv']}.txt").write_text("phone +7 999 123-45-67", encoding="utf-8")
    (texts / "some__thing.pdf__0123456789ab.txt").write_bytes(b"ok \xff")
    got = {r.relative_path: r for r in pipeline.text_only(files.text_files(spark, str(texts)), files.scan(spark, str(root))).collect()}
    assert set(got) == {"b.csv", "text-only/some/thing.pdf"} and got["b.csv"].matched and got["text-only/some/thing.pdf"].extension == ".pdf"
    assert sorted(r.ord for r in got.values()) == [0, 1]


def test_unicode_paths_match(spark):
    f = spark.createDataFrame([("сайты/й.txt", ".txt", 5)], "relative_path string, extension string, size_bytes bigint")
    decomposed = f.select(sinks.file_id(routing.path_variants("relative_path")[1]).alias("i")).first().i
    t = spark.createDataFrame([(f"/t/{decomposed}.txt", "x", 1)], "text_path string, text string, text_bytes bigint")
    assert routing.match_texts(t, f).first().matched


def test_tables(spark):
    rows = [("f.csv", ".csv", 1, i, "Иванов Иван" if i % 2 else "", f"паспорт: 4510 1{i:02d}456", "nan") for i in range(1, 31)]
    wide = spark.createDataFrame(rows, "relative_path string, extension string, size_bytes bigint, row_no int, person string, doc string, junk string")
    cells = tables.wide_rows(wide, ["person", "doc", "junk"])
    a = tables.summarise(cells).first().table_analysis
    assert (a.rows_analyzed, a.columns_total, a.sheets) == (30, 3, ["csv"]) and 25 <= a.rows_with_pii <= 30
    assert a.rows_with_sensitive_combo == a.row_combinations["full_name+passport_rf"] > 10 and a.combo_row_ratio == round(a.rows_with_sensitive_combo / 30, 4)
    assert a.pii_columns["full_name"] == ["csv:person"] and "csv:doc" in a.sensitive_columns
    short = tables.summarise(cells, max_rows=10).first().table_analysis
    assert short.warnings == ["Table analysis limited to max_rows=10"]
    assert tables.summarise(cells.limit(0)).count() == 0
    scored = pipeline.score(spark.createDataFrame([("f.csv", ".csv", 1, "")], "relative_path string, extension string, size_bytes bigint, text string"), tables.summarise(cells)).first()
    assert scored.document_type == "таблица с идентификаторами" and scored.massiveness_score >= 8


def test_video(spark):
    assert spark.range(1).select(video.frame_times(F.lit(8.1), 5).alias("x")).first().x == [0.0, 2.0, 4.0, 6.0, 8.0] == video.times(8.1, 5)
    assert spark.range(1).select(video.frame_times(F.lit(None).cast("double"), 3).alias("x")).first().x == [0.0, 0.5, 1.0] == video.times(None, 3)
    assert len(spark.range(1).select(video.frame_times(F.lit(1.7)).alias("x")).first().x) == 3 == len(video.times(1.7)) and video.times(0.2) == [0.0]
    c = [(1, 1, "rus", "full/x a", 100, "a" * 30, 0), (1, 1, "rus", "full/x b", 90, "b" * 30, 1), (1, 2, "rus", "full/x a", 80, "A" * 30, 2), (1, 3, "rus", "band/x", 60, "c" * 30, 3), (1, 4, "rus", "band/x", 44, "d" * 30, 4), (1, 0, "rus", "full/x", 50, "e" * 30, 5)]
    d = spark.createDataFrame(c, "video int, frame int, language string, variant string, score int, text string, seq int")
    got = video.snippets(d).first().snippets
    assert [s.split("\n")[1][0] for s in got] == ["e", "a", "c"] and got[1].startswith("[frame_0001; rus; full/x a; score=100]")
    assert spark.range(1).select(quality.ocr_score(F.lit("abc def 12!\nxyz qq")).alias("x")).first().x == 3 * 12 + 2 * 2 + 13 + 1 - 3
    assert [b.name for b in spark.range(1).select(video.regions(F.lit(1000), F.lit(100)).alias("x")).first().x] == ["full", "center_band"]


def test_quality(spark):
    lost = "the specic identier of the prole nds " + "word " * 200
    garbled = "npe 3a bme co6 " + "abcdefgh " * 40
    d = spark.createDataFrame([(lost, True, False), (garbled, False, True), ("short", False, False)], "t string, l boolean, g boolean")
    for r in d.select("l", "g", quality.lost_ligatures(F.col("t")).alias("a"), quality.garbled_ocr(F.col("t")).alias("b")).collect():
        assert (r.a, r.b) == (r.l, r.g)


def test_stream_scores_as_a_batch_does(spark, tmp_path):
    d = spark.createDataFrame([("личное/a.txt", ".txt", 1, "Иванов Иван Иванович, паспорт серия 4510 номер 123456, тел. +7 (999) 123-45-67"), ("b.txt", ".txt", 1, "nothing")], "relative_path string, extension string, size_bytes bigint, text string")
    d.write.parquet(str(tmp_path / "in"))
    score_stream(text_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [r.relative_path for r in got] == ["личное/a.txt"]
