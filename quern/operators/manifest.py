"""Per-document statistics, flags and extraction methods."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quern.config import ManifestConfig
from quern.functions import patterns as P
from quern.functions import text as T

COUNTS = ("n_chars", "n_lines", "n_tokens", "blank_lines", "avg_line_len", "max_line_len", "digit_ratio", "upper_ratio", "non_ascii_ratio", "email_count", "phone_like_count", "date_like_count", "money_like_count")

# What files are looked at, by their extension.
TEXT_EXTENSIONS = (".txt", ".csv", ".tsv", ".json", ".xml", ".html", ".md", ".rtf")
PDF_EXTENSIONS = (".pdf",)
IMAGE_EXTENSIONS = (".png", ".jpg", ".jpeg", ".tif", ".tiff", ".bmp", ".webp")
BINARY_EXTENSIONS = (".xls", ".xlsx", ".doc", ".docx", ".eml", ".msg")
PLAIN_EXTENSIONS = (".txt", ".csv", ".tsv", ".json", ".xml", ".html", ".pdf", ".md")
SKIPPED_NAMES, SKIPPED_PREFIXES, SKIPPED_FOLDERS = (".DS_Store",), ("._",), ("__MACOSX",)


def text_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the 13 columns of ``COUNTS`` (replaced if there).

    Null or empty text: zeros.  Stateless and without a shuffle, so that streams
    may pass too.
    """
    keep = [c for c in df.columns if c not in COUNTS]
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cut = df.select(*keep, t.alias("__t"), T.lines(t).alias("__lines"), F.length(t).cast("long").alias("__n"))
    t, n, lengths = F.col("__t"), F.col("__n"), F.transform("__lines", F.length)
    share = lambda count: F.when(n > 0, count / n).otherwise(0.0)
    total = F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)
    return cut.select(
        *keep,
        n.alias("n_chars"),
        F.size("__lines").cast("long").alias("n_lines"),
        T.count_tokens(t).alias("n_tokens"),
        F.size(F.filter("__lines", lambda x: T.strip(x) == "")).cast("long").alias("blank_lines"),
        (total / F.greatest(F.size("__lines"), F.lit(1))).alias("avg_line_len"),
        F.coalesce(F.array_max(lengths), F.lit(0)).cast("long").alias("max_line_len"),
        share(T.digits(t)).alias("digit_ratio"),
        share(T.uppers(t)).alias("upper_ratio"),
        share(T.non_ascii(t)).alias("non_ascii_ratio"),
        T.count_emails(t).alias("email_count"),
        T.count_matches(t, P.PHONE).alias("phone_like_count"),
        T.count_matches(t, P.DATE).alias("date_like_count"),
        T.count_matches(t, P.MONEY, True).alias("money_like_count"),
    )


def extension(basename: Column) -> Column:
    return F.lower(F.regexp_extract(basename, r"^.+(\.[^.]+)$", 1))


def skipped(rel_path: Column, basename: Column) -> Column:
    folder = F.exists(F.split(rel_path, "/"), lambda x: x.isin(*SKIPPED_FOLDERS))
    return basename.isin(*SKIPPED_NAMES) | basename.startswith(SKIPPED_PREFIXES[0]) | folder


def family(ext: Column) -> Column:
    out = F.when(ext.isin(*TEXT_EXTENSIONS), "text").when(ext.isin(*PDF_EXTENSIONS), "pdf")
    return out.when(ext.isin(*IMAGE_EXTENSIONS), "image").when(ext.isin(*BINARY_EXTENSIONS), "binary").otherwise("other")


def triage(df: DataFrame, config: ManifestConfig = ManifestConfig()) -> DataFrame:
    """Flags from doc_family and the counts."""
    has_text = F.col("n_chars") >= config.least_chars
    kind = F.col("doc_family")
    return df.withColumns(
        {
            "has_text": has_text,
            "text_missing": F.coalesce(kind.isin("pdf", "image"), F.lit(False)) & ~has_text,
            "text_usable_now": F.coalesce(kind.isin("text", "pdf"), F.lit(False)) & has_text,
            "has_emails": F.col("email_count") > 0,
            "has_phones": F.col("phone_like_count") > 0,
            "has_dates": F.col("date_like_count") > 0,
            "has_money": F.col("money_like_count") > 0,
        }
    )


def needs_ocr(pdf_text: Column, config: ManifestConfig = ManifestConfig()) -> Column:
    return F.length(T.strip(pdf_text)) < config.ocr_below_chars


def merged_text(text: Column, ocr_text: Column) -> Column:
    """Embedded text and OCR text, those that are not empty, with a blank line between."""
    return T.strip(F.concat_ws("\n\n", F.nullif(text, F.lit("")), F.nullif(ocr_text, F.lit(""))))


def extraction_method(kind: Column, pending: Column, text: Column, ocr_text: Column) -> Column:
    """The label of how a document's text was got, after OCR."""
    read, seen = F.coalesce(text, F.lit("")) != "", F.coalesce(ocr_text, F.lit("")) != ""
    pdf = F.when(read & seen, "pdf_text+pdf_ocr_first_page").when(seen, "pdf_ocr_only_first_page").when(read, "pdf_text_only").otherwise("pdf_no_text")
    out = F.when(kind == "text", "textlike").when((kind == "pdf") & ~pending, "pdf_text_only").when(kind == "pdf", pdf)
    return out.when(kind == "image", "image_meta_only").otherwise("binary_interesting")


def value_counts(df: DataFrame, columns: list[str], top: int | None = None) -> DataFrame:
    """Rows for each combination of values (of several columns, those without a null),
    most frequent first; with ``top`` only so many."""
    some = df.dropna(subset=columns) if len(columns) > 1 else df.where(F.col(columns[0]).isNotNull())
    out = some.groupBy(*columns).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), *columns).limit(top) if top is not None else out


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """One row: how many different values that are not null the column has."""
    return df.agg(F.count_distinct(column).alias("n_distinct"))


def counted(df: DataFrame, name: str = "manifest") -> tuple[DataFrame, Observation]:
    """``df`` and the counters of a run over it, filled as its rows pass: no job of their own.

    rows, text_rows (with text), empty_rows, ocr_errors (0 without that column), bytes.
    """
    told, none = Observation(name), F.lit(False)
    have = lambda c, test: test if c in df.columns else none
    size = F.col("size_bytes") if "size_bytes" in df.columns else F.lit(0).cast("long")
    counters = {
        "rows": F.count("*"),
        "text_rows": F.count_if(have("has_text", F.col("has_text"))),
        "empty_rows": F.count_if(F.col("n_chars") == 0),
        "ocr_errors": F.count_if(have("ocr_error", F.col("ocr_error") != "")),
        "bytes": F.coalesce(F.sum(size), F.lit(0)),
    }
    return df.observe(told, *[c.alias(n) for n, c in counters.items()]), told


@contextmanager
def timed(timings: dict[str, float], step: str) -> Iterator[None]:
    """Adds the seconds of a block to ``timings[step]``."""
    began = time.perf_counter()
    try:
        yield
    finally:
        timings[step] = timings.get(step, 0.0) + time.perf_counter() - began
