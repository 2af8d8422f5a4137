"""Raw files and artifacts as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.ids import content_hash, document_id
from leafmill.functions.text import stripped

# --- Fixed values: media types of file name endings, and families of media. ---------------------------------------

MEDIA = {
    "pdf": "application/pdf", "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "tif": "image/tiff", "tiff": "image/tiff",
    "bmp": "image/bmp", "webp": "image/webp", "gif": "image/gif", "mp3": "audio/mpeg", "wav": "audio/x-wav", "m4a": "audio/mp4",
    "flac": "audio/flac", "ogg": "audio/ogg", "mp4": "video/mp4", "mov": "video/quicktime", "avi": "video/x-msvideo",
    "mkv": "video/x-matroska", "webm": "video/webm", "txt": "text/plain", "md": "text/markdown", "html": "text/html", "htm": "text/html",
    "csv": "text/csv", "json": "application/json", "xml": "text/xml",
}
IMAGES = ("png", "jpg", "jpeg", "tif", "tiff", "bmp", "webp")
AUDIO = ("mp3", "wav", "m4a", "flac", "ogg")
VIDEO = ("mp4", "mov", "avi", "mkv", "webm")


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def media_type(path: Column) -> Column:
    kinds = F.create_map(*(F.lit(x) for pair in MEDIA.items() for x in pair))
    return F.coalesce(F.try_element_at(kinds, suffix(path)), F.lit("application/octet-stream"))


def doc_family(path: Column) -> Column:
    """Tried in order: chat exports, texts, PDFs, screenshots and images, audio, video, other."""
    end, name = suffix(path), F.lower(F.element_at(F.split(path, "/"), -1))
    return (
        F.when(end.isin("json", "csv") & name.contains("chat"), "chat_export")
        .when(media_type(path).startswith("text/"), "text")
        .when(end == "pdf", "pdf")
        .when(end.isin(*IMAGES), F.when(name.contains("screenshot"), "screenshot").otherwise("image"))
        .when(end.isin(*AUDIO), "audio")
        .when(end.isin(*VIDEO), "video")
        .otherwise("other")
    )


def raw_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size_bytes, content, sha256, document_id, media_type, doc_family) of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    rows = files.select("path", F.col("length").alias("size_bytes"), "content", content_hash(F.col("content")).alias("sha256"))
    path = F.col("path")
    return rows.withColumns({"document_id": document_id(F.col("sha256")), "media_type": media_type(path), "doc_family": doc_family(path)})


def plain_text_pages(files: DataFrame) -> DataFrame:
    """One page per text file: bytes that are no utf-8 are left out, confidence .99, 0 where nothing remains."""
    text = stripped(F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "\ufffd", ""))
    return files.filter(F.col("doc_family") == "text").select(
        "document_id", F.lit(1).alias("page_number"), F.lit("tier0_plain_text").alias("source_tier"), text.alias("text"),
        F.when(text != "", 0.99).otherwise(0.0).alias("confidence"),
    )


def json_artifacts(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """Per-document JSON files by a glob; files that do not parse give a row of nulls, missing folders no row."""
    try:
        return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(glob)
    except Exception as e:  # the reader raises for a path that matches nothing
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def optional_decoder(name: str):
    """An optional library, imported in the worker that needs it, or None where it is not installed."""
    import importlib

    try:
        return importlib.import_module(name)
    except ImportError:
        return None


def pdf_pages(files: DataFrame) -> DataFrame:
    """(document_id, page_number, backend, candidate) of PDF pages by every text backend that is installed.

    Without a backend there are no rows: the pages then wait for a run on machines that have one."""
    import io

    import pandas as pd

    def read(batches):
        reader = optional_decoder("pypdf")
        for batch in batches:
            rows = []
            for key, content in zip(batch["document_id"], batch["content"]):
                if reader is None:
                    continue
                try:
                    for i, page in enumerate(reader.PdfReader(io.BytesIO(content)).pages, 1):
                        rows.append((key, i, "tier0_pypdf", (page.extract_text() or "").strip() or None))
                except Exception:  # a damaged file has no text layer
                    continue
            yield pd.DataFrame(rows, columns=["document_id", "page_number", "backend", "candidate"])

    pdfs = files.filter(F.col("doc_family") == "pdf").select("document_id", "content")
    return pdfs.mapInPandas(read, "document_id string, page_number int, backend string, candidate string")
