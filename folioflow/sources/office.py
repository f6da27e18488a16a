"""Pages of office files, read with the standard library from their zipped XML."""

from __future__ import annotations

import datetime as dt
import io
import itertools
import posixpath
import re
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

from folioflow.sources.pdf import read_pdf

# The namespaces of the file formats.
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
C = "{http://schemas.openxmlformats.org/drawingml/2006/chart}"


def _xml(archive: zipfile.ZipFile, name: str) -> ElementTree.Element:
    data = archive.read(name)
    if b"<!DOCTYPE" in data or b"<!ENTITY" in data:
        raise ValueError("entities are not allowed")
    return ElementTree.fromstring(data)


def _numbered(archive: zipfile.ZipFile, pattern: str) -> list[str]:
    found = [(int(m.group(1)), n) for n in archive.namelist() if (m := re.fullmatch(pattern, n))]
    return [n for _, n in sorted(found)]


def read_text(content: bytes) -> list[str]:
    """Form feeds part pages."""
    return content.decode("utf-8", "replace").split("\f")


def read_docx(content: bytes) -> list[str]:
    """Pages as the file's explicit page breaks part them; headings by their style."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body = _xml(archive, "word/document.xml").find(f"{W}body")
    pages: list[list[str]] = [[]]
    for element in body if body is not None else []:
        if element.tag == f"{W}tbl":
            for row in element.iter(f"{W}tr"):
                cells = ["".join(t.text or "" for t in cell.iter(f"{W}t")) for cell in row.iter(f"{W}tc")]
                pages[-1].append("| " + " | ".join(cells) + " |")
            continue
        if any(br.get(f"{W}type") == "page" for br in element.iter(f"{W}br")):
            pages.append([])
        text = "".join(t.text or "" for t in element.iter(f"{W}t"))
        style = element.find(f"{W}pPr/{W}pStyle")
        level = re.fullmatch(r"Heading(\d)", style.get(f"{W}val") or "") if style is not None else None
        if text:
            pages[-1].append("#" * int(level.group(1)) + " " + text if level else text)
    return ["\n".join(p) for p in pages]


def read_pptx(content: bytes) -> list[str]:
    """One page for each slide; speaker notes under a heading of their own."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        pages = []
        names = set(archive.namelist())
        for name in _numbered(archive, r"ppt/slides/slide(\d+)\.xml"):
            lines = ["".join(t.text or "" for t in p.iter(f"{A}t")) for p in _xml(archive, name).iter(f"{A}p")]
            page = "\n".join(x for x in lines if x.strip())
            rels = name.replace("slides/", "slides/_rels/") + ".rels"
            if rels in names:
                for rel in _xml(archive, rels):
                    target = "ppt/" + (rel.get("Target") or "").removeprefix("../")
                    if "notesSlide" in target and target in names:
                        notes = ["".join(t.text or "" for t in p.iter(f"{A}t")) for p in _xml(archive, target).iter(f"{A}p")]
                        text = "\n".join(x for x in notes if x.strip())
                        page += f"\n\n## Speaker Notes\n{text}" if text else ""
            pages.append(page)
    return pages


def cell_text(value: object, number_format: str = "") -> str:
    """A typed cell as text: midnight times as dates, floats to 15 digits, or as percentages if their format is one."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, dt.datetime):
        return value.strftime("%Y-%m-%d" if value.time() == dt.time() else "%Y-%m-%d %H:%M:%S")
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, float):
        return f"{value * 100:.10g}%" if "%" in number_format else f"{value:.15g}"
    return re.sub(r"\r\n?", "\n", str(value))


def _letters(n: int) -> str:
    name = ""
    while n:
        n, rest = divmod(n - 1, 26)
        name = chr(65 + rest) + name
    return name


def _formats(archive: zipfile.ZipFile, names: set[str]) -> list[str]:
    """The number format of each cell style; the built-in ones that matter are those of percentages, dates and times."""
    if "xl/styles.xml" not in names:
        return []
    root = _xml(archive, "xl/styles.xml")
    known = {9: "0%", 10: "0.00%", **dict.fromkeys((14, 15, 16, 17, 22, 27, 30, 36, 50, 57), "yyyy-mm-dd"), **dict.fromkeys((18, 19, 20, 21, 45, 46, 47), "h:mm")}
    known |= {int(f.get("numFmtId")): f.get("formatCode") or "" for f in root.iter(f"{S}numFmt")}
    styles = root.find(f"{S}cellXfs")
    return [known.get(int(x.get("numFmtId") or 0), "") for x in styles] if styles is not None else []


def _number(text: str, number_format: str, epoch: dt.datetime) -> str:
    """A stored number as its format means it: a date or time, a percentage or a number."""
    number = float(text)
    bare = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", number_format).lower()
    if "general" not in bare and re.search(r"[ymdhs]", bare):
        return cell_text(epoch + dt.timedelta(seconds=round(number * 86400)))
    return cell_text(int(number) if number.is_integer() and "%" not in number_format else number, number_format)


#: Points of a chart's series that are shown.
POINTS = 12


def _charts(archive: zipfile.ZipFile, names: set[str], sheet: str) -> list[str]:
    """The charts on a sheet as block quotes: title, and of each series the points that the file holds; the shorter side is padded with blanks."""
    def targets(part: str, word: str) -> list[str]:
        folder, _, name = part.rpartition("/")
        rels = f"{folder}/_rels/{name}.rels"
        found = [r.get("Target") or "" for r in _xml(archive, rels)] if rels in names else []
        return [t for f in found if word in f and (t := posixpath.normpath(f if f.startswith("/") else f"{folder}/{f}").lstrip("/")) in names]

    lines = []
    for drawing in targets(sheet, "drawing"):
        for part in targets(drawing, "chart"):
            root = _xml(archive, part)
            title = root.find(f".//{C}title")
            name = "".join(t.text or "" for t in title.iter(f"{A}t")) if title is not None else ""
            lines.append(f"> Chart: {name}".rstrip())
            for k, series in enumerate(root.iter(f"{C}ser")):
                def points(tag: str, series=series) -> list[str]:
                    at = series.find(f"{C}{tag}")
                    return [v.text or "" for p in at.iter(f"{C}pt") for v in p.iter(f"{C}v")] if at is not None else []

                label = " ".join(points("tx")) or f"Series {k + 1}"
                pairs = itertools.islice(itertools.zip_longest(points("cat") or points("xVal"), points("val") or points("yVal"), fillvalue=""), POINTS)
                lines.append(f"> - {label}: " + "; ".join(f"{c}: {v}" for c, v in pairs))
    return lines


def read_xlsx(content: bytes) -> list[str]:
    """One page for each sheet: a table of its populated rows and columns, and its charts. Numbers are shown as their formats mean them."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        names = set(archive.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{S}t")) for si in _xml(archive, "xl/sharedStrings.xml")]
        targets = {}
        if "xl/_rels/workbook.xml.rels" in names:
            targets = {r.get("Id"): "xl/" + (r.get("Target") or "").removeprefix("/xl/") for r in _xml(archive, "xl/_rels/workbook.xml.rels")}
        workbook, formats, pages = _xml(archive, "xl/workbook.xml"), _formats(archive, names), []
        later = any((p.get("date1904") or "") in ("1", "true") for p in workbook.iter(f"{S}workbookPr"))
        epoch = dt.datetime(1904, 1, 1) if later else dt.datetime(1899, 12, 30)
        for sheet in workbook.iter(f"{S}sheet"):
            target = targets.get(sheet.get(f"{R}id"), f"xl/worksheets/sheet{sheet.get('sheetId')}.xml")
            rows: dict[int, dict[int, str]] = {}
            for cell in _xml(archive, target).iter(f"{S}c"):
                place = re.fullmatch(r"([A-Z]+)(\d+)", cell.get("r") or "")
                raw = cell.find(f"{S}v")
                kind = cell.get("t")
                if kind == "inlineStr":
                    text = "".join(t.text or "" for t in cell.iter(f"{S}t"))
                elif raw is None or raw.text is None:
                    text = ""
                elif kind == "s":
                    text = shared[int(raw.text)]
                elif kind == "b":
                    text = cell_text(raw.text == "1")
                elif kind in ("str", "e"):
                    text = raw.text
                else:
                    style = int(cell.get("s") or 0)
                    text = _number(raw.text, formats[style] if style < len(formats) else "", epoch)
                if place and text:
                    column = 0
                    for ch in place.group(1):
                        column = column * 26 + ord(ch) - 64
                    rows.setdefault(int(place.group(2)), {})[column] = text.replace("|", "\\|").replace("\n", " ")
            columns = sorted({c for r in rows.values() for c in r})
            lines = [f"# Sheet: {sheet.get('name')}", ""]
            if columns:
                lines += ["| Row | " + " | ".join(_letters(c) for c in columns) + " |", "| " + " | ".join(["---"] * (len(columns) + 1)) + " |"]
                lines += [f"| {n} | " + " | ".join(rows[n].get(c, "") for c in columns) + " |" for n in sorted(rows)]
            if charts := _charts(archive, names, target):
                lines += ["", *charts]
            pages.append("\n".join(lines))
    return pages


READERS: dict[str, Callable[[bytes], list[str]]] = {"txt": read_text, "md": read_text, "pdf": read_pdf, "docx": read_docx, "pptx": read_pptx, "xlsx": read_xlsx}
