"""What opens single files: charset, PDF text, OCR of a page, image headers.

Each reader takes a file's bytes and gives a dict, or raises; ``column`` makes a
column of it in which a broken file is an error in its own row.  The libraries are
optional: where one is missing the reader raises ImportError, once for each file.
"""

from __future__ import annotations

import io
from collections.abc import Callable
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def charset(raw: bytes) -> dict:
    """A detector's best guess."""
    from charset_normalizer import from_bytes

    best = from_bytes(raw).best()
    if best is None:
        raise ValueError("no charset fits")
    return {"text": str(best), "encoding": f"cn:{best.encoding}"}


def latin(raw: bytes, error: Exception) -> dict:
    """What is left when nothing else fits: every byte is a character."""
    return {"text": raw.decode("latin-1"), "encoding": "latin-1"}


def _opened(raw: bytes):
    import fitz

    return fitz.open(stream=raw, filetype="pdf")


def pdf_text(pages: int, chars: int) -> Callable[[bytes], dict]:
    """Text of the first ``pages`` pages; none is read once ``chars`` characters are there."""

    def read(raw: bytes) -> dict:
        with _opened(raw) as doc:
            room, parts = chars, []
            for page in islice(doc, pages if chars > 0 else 0):
                parts.append(page.get_text("text"))
                room -= len(parts[-1])
                if room <= 0:
                    break
            return {"text": "\n".join(parts).strip(), "pages": len(doc), "error": ""}

    return read


def no_pdf(raw: bytes, error: Exception) -> dict:
    return {"text": "", "pages": 0, "error": "" if isinstance(error, ImportError) else f"pdf_text_failed:{type(error).__name__}"}


def first_page_ocr(dpi: int) -> Callable[[bytes], dict]:
    """The words seen on the first page, drawn at ``dpi`` dots an inch."""

    def read(raw: bytes) -> dict:
        with _opened(raw) as doc:
            drawn = [page.get_pixmap(dpi=dpi).tobytes("png") for page in islice(doc, 1)]
        if not drawn:
            return {"text": "", "error": "pdf_no_pages"}
        import pytesseract
        from PIL import Image

        return {"text": pytesseract.image_to_string(Image.open(io.BytesIO(drawn[0]))).strip(), "error": ""}

    return read


def no_ocr(raw: bytes, error: Exception) -> dict:
    code = f"ocr_pdf_failed:{type(error).__name__}:{error}"
    if isinstance(error, ImportError):
        code = "pymupdf_missing" if error.name == "fitz" else "pytesseract_or_pillow_missing"
    return {"text": "", "error": code}


def ocr_missing() -> str:
    """Empty, or why there can be no OCR at all."""
    try:
        import pytesseract

        pytesseract.get_tesseract_version()
    except Exception:
        return "tesseract_binary_not_found"
    return ""


def image_header(raw: bytes) -> dict:
    from PIL import Image

    with Image.open(io.BytesIO(raw)) as image:
        width, height = image.size
        return {"width": width, "height": height, "format": image.format, "mode": image.mode}


def no_image(raw: bytes, error: Exception) -> dict:
    return dict.fromkeys(("width", "height", "format", "mode"))


@dataclass(frozen=True)
class Readers:
    """The readers of a manifest, each made from its settings; tests put others in their place."""

    charset: Callable[[bytes], dict] = charset
    pdf: Callable[[int, int], Callable[[bytes], dict]] = pdf_text
    ocr: Callable[[int], Callable[[bytes], dict]] = first_page_ocr
    image: Callable[[bytes], dict] = image_header
    ocr_missing: Callable[[], str] = ocr_missing


def column(content: Column, read: Callable[[bytes], dict], broken: Callable[[bytes, Exception], dict], fields: str) -> Column:
    """``read`` of each file as a struct of ``fields``; where it raises, ``broken`` of the file and the error.

    A null content is an empty file.
    """
    kinds = {"string": pa.string(), "int": pa.int32()}
    struct = pa.struct([(name, kinds[kind]) for name, kind in (x.split(":") for x in fields.split(","))])

    def one(raw: bytes) -> dict:
        try:
            return read(raw)
        except Exception as error:
            return broken(raw, error)

    @F.arrow_udf(f"struct<{fields}>")
    def run(files: pa.Array) -> pa.Array:
        return pa.array([one(x.as_py() or b"") for x in files], struct)

    return run(content)
