"""Light probes of binary files and imports of page snapshots: what can be said of a file without a parser of its format."""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PDF_INFO = re.compile(rb"/(Title|Author|Creator|Producer|CreationDate|ModDate)\s*\(((?:[^()\\]|\\.)*)\)")


def probe(data: bytes | None, path: str) -> tuple[str, int | None, dict[str, str]]:
    """(status, page or sheet count, properties): empty, password_protected, corrupt or ok. Nothing is repaired."""
    if not data:
        return "empty", None, {}
    low = path.lower()
    if data[:4] == b"%PDF":
        if re.search(rb"/Encrypt\s+\d+\s+\d+\s+R", data):
            return "password_protected", None, {}
        if b"%%EOF" not in data[-2048:]:
            return "corrupt", None, {}
        pages = len(re.findall(rb"/Type\s*/Page(?![a-zA-Z])", data)) or None
        return "ok", pages, {k.decode(): _pdf_text(v) for k, v in _PDF_INFO.findall(data)}
    if data[:4] == b"PK\x03\x04":
        try:
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                if z.testzip() is not None:
                    return "corrupt", None, {}
                names = z.namelist()
        except (zipfile.BadZipFile, RuntimeError, OSError):
            return "corrupt", None, {}
        sheets = sum(n.startswith("xl/worksheets/sheet") for n in names)
        return "ok", sheets if low.endswith(".xlsx") else None, {}
    if data[:8] == bytes.fromhex("D0CF11E0A1B11AE1") and low.endswith((".docx", ".xlsx")):
        return "password_protected", None, {}
    size = image_size(data)
    if not size:
        return "ok", None, {}
    average = png_hash(data)
    return "ok", None, {"width": str(size[0]), "height": str(size[1]), **exif(data), **({"ahash": average} if average else {})}


def _pdf_text(raw: bytes) -> str:
    raw = re.sub(rb"\\([()\\])", rb"\1", raw)
    return raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("latin-1")


def image_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) of a PNG or JPEG."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return struct.unpack(">II", data[16:24])
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(data) and data[at] == 0xFF:
            kind, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                return w, h
            at += 2 + size
    return None


#: Tags of photographs that are kept, by number (fixed values).
EXIF_TAGS = {0x010F: "Make", 0x0110: "Model", 0x0131: "Software", 0x0132: "DateTime", 0x013B: "Artist", 0x9003: "DateTimeOriginal", 0x9004: "DateTimeDigitized", 0xA431: "BodySerialNumber"}


def exif(data: bytes) -> dict[str, str]:
    """Text tags of a JPEG; damaged ones are left out."""
    at = data.find(b"Exif\0\0")
    tiff = data[at + 6 :] if at >= 0 else b""
    order = {b"II": "<", b"MM": ">"}.get(tiff[:2])
    out: dict[str, str] = {}
    todo = [struct.unpack(order + "I", tiff[4:8])[0]] if order and len(tiff) >= 8 else []
    for _ in range(3):  # the main directory and those it points to
        if not todo:
            break
        at = todo.pop(0)
        if at + 2 > len(tiff):
            continue
        for k in range(struct.unpack(order + "H", tiff[at : at + 2])[0]):
            entry = tiff[at + 2 + 12 * k : at + 14 + 12 * k]
            if len(entry) < 12:
                break
            tag, kind, n = struct.unpack(order + "HHI", entry[:8])
            if tag == 0x8769:
                todo.append(struct.unpack(order + "I", entry[8:])[0])
            elif tag in EXIF_TAGS and kind == 2:
                start = struct.unpack(order + "I", entry[8:])[0]
                raw = entry[8 : 8 + n] if n <= 4 else tiff[start : start + n]
                if len(raw) == n and raw.strip(b"\0 "):
                    out[EXIF_TAGS[tag]] = raw.strip(b"\0 ").decode("utf-8", "replace")
    return out


def png_hash(data: bytes, side: int = 8) -> str | None:
    """Average hash of a PNG with 8 bits a channel: the picture in side x side boxes, one bit a box for at least the mean."""
    size, at, packed, kind = image_size(data), 8, b"", None
    while at + 8 <= len(data):
        n, name = struct.unpack(">I", data[at : at + 4])[0], data[at + 4 : at + 8]
        if name == b"IHDR":
            kind = (data[at + 16 : at + 17], data[at + 17 : at + 18], data[at + 20 : at + 21])
        packed += data[at + 8 : at + 8 + n] if name == b"IDAT" else b""
        at += 12 + n
    channels = {b"\0": 1, b"\2": 3, b"\4": 2, b"\6": 4}.get(kind[1]) if kind else None
    if not size or not channels or kind[0] != b"\x08" or kind[2] != b"\0":
        return None
    try:
        raw = zlib.decompressobj().decompress(packed)
    except zlib.error:
        return None
    width, height = size
    line = width * channels
    if len(raw) < height * (line + 1):
        return None
    sums, counts, before = [0.0] * side**2, [0] * side**2, bytearray(line)
    for y in range(height):
        f, row = raw[y * (line + 1)], bytearray(raw[y * (line + 1) + 1 : (y + 1) * (line + 1)])
        for i in range(line):
            a, b, c = row[i - channels] if i >= channels else 0, before[i], before[i - channels] if i >= channels else 0
            near = min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
            row[i] = (row[i] + (0, a, b, (a + b) // 2, near)[f]) & 255
        for x in range(width):
            p = row[x * channels : x * channels + channels]
            k = y * side // height * side + x * side // width
            sums[k] += p[0] if channels < 3 else 0.299 * p[0] + 0.587 * p[1] + 0.114 * p[2]
            counts[k] += 1
        before = row
    means = [s / n if n else 0.0 for s, n in zip(sums, counts)]
    mean = sum(means) / len(means)
    return f"{int(''.join('1' if m >= mean else '0' for m in means), 2):0{side * side // 4}x}"


def probed(files: DataFrame) -> DataFrame:
    """(relative_path, sha256, status, units, properties) of (relative_path, content); a file that cannot be read is a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, sha, data in zip(pdf["relative_path"], pdf["sha256"], pdf["content"]):
                try:
                    rows.append((path, sha, *probe(None if data is None else bytes(data), path)))
                except Exception as e:  # a broken file never fails the task
                    rows.append((path, sha, f"corrupt: {type(e).__name__}", None, {}))
            yield pd.DataFrame(rows, columns=["relative_path", "sha256", "status", "units", "properties"])

    slim = files.select("relative_path", F.sha2("content", 256).alias("sha256"), "content")
    return slim.mapInPandas(run, "relative_path string, sha256 string, status string, units int, properties map<string,string>")


SNAPSHOT_KEYS = ("queried_by", "queried_at", "url_or_channel", "subject", "visible_result")


def snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Page snapshots with their ``.meta.json`` of the same stem: which mandatory keys are missing, and the strength B or C.

    A snapshot without meta file has all keys missing; the content itself is not read, only its length.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    images = raw.where(F.lower("path").rlike(r"\.(png|jpe?g|pdf|html?)$")).withColumn("stem", F.regexp_replace("path", r"\.[^.]+$", ""))
    meta = spark.read.schema(", ".join(f"{k} string" for k in (*SNAPSHOT_KEYS, "uscc", "status"))).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.meta.json").json(root)
    meta = meta.withColumn("stem", F.regexp_replace(F.col("_metadata.file_path"), r"\.meta\.json$", ""))
    plain = lambda c: F.regexp_replace(c, "^file:/*", "/")
    j = images.withColumn("stem", plain("stem")).join(meta.withColumn("stem", plain("stem")), "stem", "left")
    missing = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(F.col(k)), F.lit("")) == "", F.lit(k)) for k in SNAPSHOT_KEYS]))
    return j.select("path", "length", *SNAPSHOT_KEYS, "uscc", "status", missing.alias("missing"), F.when(F.size(missing) == 0, "B").otherwise("C").alias("strength"))
