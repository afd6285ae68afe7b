"""Bytes to text by kind of file, with the standard library alone. Kinds that can't be read give an error, never a guess."""

from __future__ import annotations

import csv
import io
import json
import mimetypes
import zipfile
from xml.etree import ElementTree

from ..functions import fixed
from ..operators.clean import page_parts

TEXT_ENDINGS = (".txt", ".md", ".rst", ".log", ".py", ".rs", ".go", ".c", ".h", ".cpp", ".js", ".ts", ".java", ".rb", ".sql", ".sh", ".yaml", ".yml", ".toml", ".ini", ".cfg")


def decode(raw: bytes) -> str:
    """The first of these encodings that fits."""
    for name in ("utf-8-sig", "utf-16", "utf-32", "cp1252", "latin-1"):
        try:
            return raw.decode(name)
        except UnicodeError:
            continue
    raise ValueError("no encoding fits")


def parse_csv(raw: bytes, delimiter: str | None = None) -> str:
    """Records as 'name: value' lines under the number of their row; the first row names the columns unless it is blank."""
    text = decode(raw).replace("\x00", "")
    if delimiter is None:
        try:
            delimiter = csv.Sniffer().sniff(text[:65536], ",\t;|").delimiter
        except csv.Error:
            delimiter = ","
    rows = list(csv.reader(io.StringIO(text), delimiter=delimiter))
    width = max(map(len, rows), default=0)
    filled = lambda r: any(v.strip() for v in r)
    named = bool(rows) and filled(rows[0])
    names = [v.strip() for v in rows[0]] if named else []
    names = [(names[i] if i < len(names) else "") or f"column_{i + 1}" for i in range(width)]
    records = [(n, r + [""] * (width - len(r))) for n, r in enumerate(rows, 1) if filled(r)][named:]
    if not records:
        raise ValueError("a table without a record that holds anything")
    return "\n\n".join(f"record {n}\n" + "\n".join(f"{h}: {v}" for h, v in zip(names, r, strict=True)) for n, r in records)


def _canonical(x) -> str:
    return json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def parse_json(raw: bytes) -> str:
    x = json.loads(decode(raw))
    if x == []:
        raise ValueError("JSON without a record")
    return "\n".join(map(_canonical, x)) if isinstance(x, list) else _canonical(x)


def parse_jsonl(raw: bytes) -> str:
    out = []
    for n, line in enumerate(decode(raw).splitlines(), 1):
        if line.strip():
            try:
                out.append(_canonical(json.loads(line)))
            except ValueError as e:
                raise ValueError(f"line {n} is not JSON: {e}") from e
    if not out:
        raise ValueError("JSON lines without a record")
    return "\n".join(out)


def parse_xml(raw: bytes) -> str:
    if b"<!DOCTYPE" in raw.upper() or b"<!ENTITY" in raw.upper():
        raise ValueError("XML with a document type or entities is not read")
    return " ".join(t.strip() for t in ElementTree.fromstring(raw).itertext() if t.strip())


def _some(text: str, kind: str) -> str:
    """``text``; a file of this kind that gives none is an error, so no empty document comes of it."""
    if not text.strip():
        raise ValueError(f"{kind} without text")
    return text


def _zip_xml(raw: bytes, names: str) -> list[tuple[str, ElementTree.Element]]:
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        found = sorted((n for n in z.namelist() if n.startswith(names) and n.endswith(".xml") and "/_rels/" not in n), key=lambda n: (len(n), n))
        return [(n, ElementTree.fromstring(z.read(n))) for n in found]


def _local(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2]


def _runs(e: ElementTree.Element) -> str:
    return "".join(x.text or "" for x in e.iter() if _local(x) == "t")


def parse_docx(raw: bytes) -> str:
    body = next(e for e in _zip_xml(raw, "word/document")[0][1] if _local(e) == "body")
    out, n = [p for e in body if _local(e) == "p" and (p := _runs(e).strip())], 0
    for table in (e for e in body if _local(e) == "tbl"):
        n += 1
        out.append(f"[TABLE {n}]\n" + "\n".join(" | ".join(_runs(c).strip() for c in row if _local(c) == "tc") for row in table if _local(row) == "tr"))
    return "\n\n".join(out)


def parse_pptx(raw: bytes) -> str:
    slides = [(n, [t for p in root.iter() if _local(p) == "p" and (t := _runs(p).strip())]) for n, (_, root) in enumerate(_zip_xml(raw, "ppt/slides/slide"), 1)]
    return "\n\n".join(f"[SLIDE {n}]\n" + "\n".join(parts) for n, parts in slides if parts)


def _column(reference: str) -> int:
    """The place of a cell's column, from 0, by a reference such as AB12; 0 without one."""
    n = 0
    for ch in reference:
        if not "A" <= ch <= "Z":
            break
        n = 26 * n + ord(ch) - 64
    return max(n - 1, 0) if n <= 16_384 else 0


def parse_xlsx(raw: bytes) -> str:
    shared = [_runs(e) for _, root in _zip_xml(raw, "xl/sharedStrings") for e in root if _local(e) == "si"]
    names = [e.get("name", "") for _, root in _zip_xml(raw, "xl/workbook") for e in root.iter() if _local(e) == "sheet"]
    out = []
    for n, (_, root) in enumerate(_zip_xml(raw, "xl/worksheets/sheet")):
        rows = []
        for row in (e for e in root.iter() if _local(e) == "row"):
            cells: list[str] = []
            for c in row:
                at = _column(c.get("r", ""))
                cells += [""] * (at - len(cells))  # empty cells are left out of the file
                v = next((x.text or "" for x in c if _local(x) == "v"), _runs(c))
                cells.append(shared[int(v)] if c.get("t") == "s" and v else v)
            rows.append(cells)
        width = max(map(len, rows), default=0)
        head = [(v or "").strip() or f"column_{i + 1}" for i, v in enumerate((rows[0] if rows else []) + [""] * width)][:width]
        records = ["\n".join(f"{h}: {v or ''}" for h, v in zip(head, r + [""] * width, strict=False)) for r in rows[1:] if any((v or "").strip() for v in r)]
        if records:
            out.append(f"[SHEET {names[n] if n < len(names) else n + 1}]\n" + "\n\n".join(records))
    return "\n\n".join(out)


def parse(raw: bytes, url: str, mime: str = "") -> dict:
    """text, title, content_type, links; by ending, then by MIME type, given or guessed."""
    ending = "." + url.lower().split("?")[0].rsplit("/", 1)[-1].rpartition(".")[2]
    mime = (mime or mimetypes.guess_type(url)[0] or "").split(";")[0].strip().lower()
    plain = lambda text, kind: {"text": text, "title": "", "content_type": kind, "links": []}
    if ending in (".html", ".htm", ".xhtml") or mime == "text/html":
        text, title, links = page_parts(decode(raw), fixed.PARSE_DROPPED)
        return {"text": _some(" ".join(text.split()), "HTML"), "title": title, "content_type": "html", "links": links}
    for ends, kinds, read, name in (
        ((".csv",), ("text/csv",), parse_csv, "tabular_data"), ((".tsv",), ("text/tab-separated-values",), lambda r: parse_csv(r, "\t"), "tabular_data"),
        ((".jsonl", ".ndjson"), ("application/x-ndjson",), parse_jsonl, "structured_data"), ((".json",), ("application/json", "application/ld+json"), parse_json, "structured_data"),
        ((".xml",), ("application/xml", "text/xml"), parse_xml, "structured_data"), ((".docx",), ("application/vnd.openxmlformats-officedocument.wordprocessingml.document",), parse_docx, "document"),
        ((".xlsx", ".xlsm"), ("application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",), parse_xlsx, "tabular_data"),
        ((".pptx",), ("application/vnd.openxmlformats-officedocument.presentationml.presentation",), parse_pptx, "presentation"),
    ):
        if ending in ends or mime in kinds:
            return plain(_some(read(raw), ends[0]), name)
    if ending == ".pdf" or mime == "application/pdf":
        try:
            from pypdf import PdfReader  # optional
        except ImportError as e:
            raise ValueError("no PDF reader is installed") from e
        pages = [(p.extract_text() or "").strip() for p in PdfReader(io.BytesIO(raw)).pages]
        if not any(pages):
            raise ValueError("a PDF of images has no text")
        return plain("\n\n".join(f"[PAGE {n}]\n{p}" for n, p in enumerate(pages, 1) if p), "document_pdf")
    if ending in TEXT_ENDINGS or mime.startswith("text/"):
        return plain(decode(raw), "text")
    raise ValueError(f"unsupported content type: {url}")


def parse_or_error(raw: bytes, url: str) -> dict:
    try:
        return parse(raw, url) | {"error": None}
    except Exception as e:
        return {"text": None, "title": None, "content_type": None, "links": None, "error": f"{type(e).__name__}: {e}"}
