"""Media columns: what a binary column really holds, and what is embedded in it.

An Aho-Corasick automaton over all known magic bytes finds every place where a file could begin, in one pass; a
validator of that format then walks the structure (chunks, segments, boxes, checksums, lengths) and either confirms the
file with its exact length or refuses it. A confirmed file at offset 0 corrects the declared type; every other
confirmed file is carved out as an embedded one.

Everything is a projection: no shuffle, one Arrow pass, and memory bounded by a batch and its largest cell.
"""

from __future__ import annotations

import binascii
import re
import struct
import zlib
from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts, spread, table, whole

RATE = 8000
SNIFFED = "mime string, declared_ok boolean, length long, payload_offset long, payload_length long, embedded array<struct<mime:string,offset:long,length:long>>"
#: Bytes that go to the automaton at a time; neighbours overlap by the longest magic.
WINDOW = 1 << 20

# Magic bytes of the public formats.
MAGIC = [
    ("image/png", b"\x89PNG\r\n\x1a\n"),
    ("image/jpeg", b"\xff\xd8\xff"),
    ("image/gif", b"GIF87a"),
    ("image/gif", b"GIF89a"),
    ("image/bmp", b"BM"),
    ("riff", b"RIFF"),
    ("audio/ogg", b"OggS"),
    ("application/pdf", b"%PDF-"),
    ("application/zip", b"PK\x03\x04"),
    ("application/gzip", b"\x1f\x8b\x08"),
    ("ftyp", b"ftyp"),
]


class Buffer:
    """Bytes under inspection, with remembered searches so that many false starts stay linear."""

    def __init__(self, data: bytes):
        self.data, self._hits = data, {}

    def next(self, needle: bytes, at: int) -> int:
        """Where needle is first found from at on, or -1."""
        if needle not in self._hits:
            hits, p = [], self.data.find(needle)
            while p >= 0:
                hits.append(p)
                p = self.data.find(needle, p + 1)
            self._hits[needle] = hits
        hits = self._hits[needle]
        k = bisect_left(hits, at)
        return hits[k] if k < len(hits) else -1

    def once(self, name: str, find):
        """What find tells of the bytes, asked once."""
        if name not in self._hits:
            self._hits[name] = find(self.data)
        return self._hits[name]


def _u(data: bytes, at: int, fmt: str) -> int | None:
    end = at + struct.calcsize(fmt)
    return struct.unpack(fmt, data[at:end])[0] if end <= len(data) else None


def _png(b: Buffer, at: int):
    d, p, first = b.data, at + 8, True
    while (n := _u(d, p, ">I")) is not None:
        kind, end = d[p + 4 : p + 8], p + 12 + n
        if end > len(d) or first and (kind != b"IHDR" or n != 13) or zlib.crc32(d[p + 4 : end - 4]) != _u(d, end - 4, ">I"):
            return None
        if kind == b"IEND":
            return "image/png", end - at
        p, first = end, False
    return None


def _jpeg(b: Buffer, at: int):
    d, p, frame = b.data, at + 2, False
    while p + 4 <= len(d) and d[p] == 0xFF:
        mark = d[p + 1]
        if mark == 0xFF:
            p += 1
            continue
        if mark == 0xD9 or mark < 0xC0 and mark != 0x01:
            return None
        n = _u(d, p + 2, ">H")
        if n < 2 or p + 2 + n > len(d):
            return None
        frame |= 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC)
        p += 2 + n
        if mark == 0xDA:
            end = b.next(b"\xff\xd9", p)
            return ("image/jpeg", end + 2 - at) if frame and end >= 0 else None
    return None


def _gif(b: Buffer, at: int):
    d, p = b.data, at + 13
    if p > len(d):
        return None
    if d[at + 10] & 0x80:
        p += 3 << (d[at + 10] & 7) + 1
    images = 0

    def blocks(q: int) -> int | None:
        while q < len(d):
            if d[q] == 0:
                return q + 1
            q += d[q] + 1
        return None

    while p is not None and p < len(d):
        if d[p] == 0x3B:
            return ("image/gif", p + 1 - at) if images else None
        if d[p] == 0x21:
            p = blocks(p + 2)
        elif d[p] == 0x2C and p + 10 < len(d):
            local = d[p + 9]
            p = blocks(p + 11 + ((3 << (local & 7) + 1) if local & 0x80 else 0))
            images += 1
        else:
            return None
    return None


def _bmp(b: Buffer, at: int):
    d = b.data
    size, start, head = _u(d, at + 2, "<I"), _u(d, at + 10, "<I"), _u(d, at + 14, "<I")
    if head not in (12, 40, 52, 56, 64, 108, 124) or _u(d, at + 6, "<I") != 0 or not 14 + head <= start < size <= len(d) - at:
        return None
    if head == 12:
        w, h, planes, bits = (_u(d, at + k, "<H") for k in (18, 20, 22, 24))
        packed = 0
    else:
        w, h, planes, bits, packed = _u(d, at + 18, "<i"), abs(_u(d, at + 22, "<i")), _u(d, at + 26, "<H"), _u(d, at + 28, "<H"), _u(d, at + 30, "<I")
    if planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or w <= 0 or h <= 0:
        return None
    return ("image/bmp", size) if packed or start + (w * bits + 31) // 32 * 4 * h <= size else None


def _riff(b: Buffer, at: int):
    """WAVE and WEBP; for WAVE also where its samples are."""
    d, size = b.data, _u(b.data, at + 4, "<I")
    if size is None or at + 8 + size > len(d) or size < 12:
        return None
    form, end, p, seen = d[at + 8 : at + 12], at + 8 + size, at + 12, {}
    if form not in (b"WAVE", b"WEBP"):
        return None
    while p + 8 <= end:
        kind, n = d[p : p + 4], _u(d, p + 4, "<I")
        if p + 8 + n > end:
            return None
        seen.setdefault(kind, (p + 8, n))
        p += 8 + n + (n & 1)
    if form == b"WEBP":
        return ("image/webp", size + 8) if {b"VP8 ", b"VP8L", b"VP8X"} & seen.keys() else None
    if b"fmt " not in seen or b"data" not in seen or seen[b"fmt "][1] < 16:
        return None
    return "audio/wav", size + 8, seen[b"data"][0] - at, seen[b"data"][1]


def _ogg_crc(page: bytes) -> int:
    """The format's checksum: CRC-32 without reflection, initial and final value 0."""
    crc = 0
    for x in page:
        crc = (crc << 8 & 0xFFFFFFFF) ^ _OGG[crc >> 24 ^ x]
    return crc


def _ogg_table() -> list[int]:
    out = []
    for k in range(256):
        r = k << 24
        for _ in range(8):
            r = (r << 1 ^ 0x04C11DB7 if r & 0x80000000 else r << 1) & 0xFFFFFFFF
        out.append(r)
    return out


_OGG = _ogg_table()


def _ogg(b: Buffer, at: int):
    """One logical file: pages until one with the end flag, each with its checksum."""
    d, p, first = b.data, at, True
    while d[p : p + 5] == b"OggS\0" and p + 27 <= len(d):
        flags, n = d[p + 5], d[p + 26]
        end = p + 27 + n + sum(d[p + 27 : p + 27 + n])
        if end > len(d) or p + 27 + n > len(d) or first and not flags & 2 or _ogg_crc(d[p : p + 22] + bytes(4) + d[p + 26 : end]) != _u(d, p + 22, "<I"):
            return None
        if flags & 4:
            return "audio/ogg", end - at
        p, first = end, False
    return None


_PDF_END = re.compile(rb"startxref\s{1,8}[0-9]{1,20}\s{1,8}%%EOF")


def _pdf(b: Buffer, at: int):
    """Up to the last end marker with an offset before the next header: first pages and updates have markers of their own."""
    end = b.next(b"%%EOF", at)
    mark = b.next(b"startxref", at)
    heads, ends = b.once("pdf", lambda d: ([m.start() for m in re.finditer(rb"%PDF-[0-9]\.[0-9]", d)], [m.end() - 5 for m in _PDF_END.finditer(d)]))
    k = bisect_left(heads, at + 1)
    n = bisect_left(ends, heads[k] if k < len(heads) else len(b.data))
    if 0 <= mark < end and n and ends[n - 1] > end:
        end = ends[n - 1]
    return ("application/pdf", end + 5 - at) if 0 <= mark < end and _version(b.data, at + 5) else None


def _version(d: bytes, at: int) -> bool:
    return d[at : at + 1].isdigit() and d[at + 1 : at + 2] == b"." and d[at + 2 : at + 3].isdigit()


def _zips(d: bytes) -> dict[int, int]:
    """Where archives end, by where they begin, which their end record tells; stored ones inside have records of their own."""
    out, end = {}, d.find(b"PK\x05\x06")
    while end >= 0:
        if (k := _u(d, end + 20, "<H")) is not None and end + 22 + k <= len(d):
            size, start = _u(d, end + 12, "<I"), _u(d, end + 16, "<I")
            at = end - size - start
            if at >= 0 and d[at + start : at + start + 4] in (b"PK\x01\x02", b"PK\x05\x06"):
                out.setdefault(at, end + 22 + k)
        end = d.find(b"PK\x05\x06", end + 1)
    return out


def _zip(b: Buffer, at: int):
    end = b.once("zip", _zips).get(at)
    return ("application/zip", end - at) if end else None


def _member(d: bytes, at: int) -> int | None:
    """The end of one gzip member; inflating it checks its CRC and length. Output is thrown away piece by piece."""
    if d[at : at + 3] != b"\x1f\x8b\x08" or d[at + 3 : at + 4] > b"\x1f":
        return None
    z, p = zlib.decompressobj(31), at
    try:
        while not z.eof and p < len(d):
            piece = d[p : p + 65536]
            p += len(piece)
            z.decompress(piece, 1 << 20)
            while z.unconsumed_tail and not z.eof:
                z.decompress(z.unconsumed_tail, 1 << 20)
    except zlib.error:
        return None
    return p - len(z.unused_data) if z.eof else None


def _gzip(b: Buffer, at: int):
    """All members that follow each other; each is inflated once, though a later one is a file of its own as well."""
    known, seen, p = b.once("gzip", lambda d: {}), [], at
    while p not in known and (end := _member(b.data, p)):
        seen.append(p)
        p = end
    last = known.get(p, p)
    known.update(dict.fromkeys(seen, last))
    return ("application/gzip", last - at) if last > at else None


def _mp4(b: Buffer, at: int):
    """Boxes one after another; the last one may have size 0, and then goes to the end of the bytes. What follows a box is
    remembered, so that many starts in one row of boxes are walked once."""
    d, p, known, seen = b.data, at, b.once("mp4", lambda _: {}), []
    while p not in known and (n := _u(d, p, ">I")) is not None and p + 8 <= len(d):
        kind, head = d[p + 4 : p + 8], 8
        if n == 1:
            n, head = _u(d, p + 8, ">Q") or 0, 16
        if n == 0 and kind in (b"mdat", b"moov", b"moof", b"free"):
            n = len(d) - p
        if n < head or p + n > len(d) or not kind.isalnum():
            break
        seen.append((p, kind))
        p += n
    end, media = known.get(p, (p, False))
    for q, kind in reversed(seen):
        media = media or kind in (b"moov", b"mdat", b"moof")
        known[q] = end, media
    return ("video/mp4", end - at) if media else None


CHECKS = {
    "image/png": _png,
    "image/jpeg": _jpeg,
    "image/gif": _gif,
    "image/bmp": _bmp,
    "riff": _riff,
    "audio/ogg": _ogg,
    "application/pdf": _pdf,
    "application/zip": _zip,
    "application/gzip": _gzip,
    "ftyp": _mp4,
}


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, magic in MAGIC:
        a.add_word(magic.decode("latin-1"), (kind, len(magic)))
    a.make_automaton()
    return a


def sniff(data: bytes | None, search=None) -> list[tuple]:
    """Every confirmed file in data as (offset, mime, length[, samples' offset, samples' length]), by offset."""
    if not data:
        return []
    search, b, out, over = search or automaton(), Buffer(data), {}, max(len(m) for _, m in MAGIC) - 1
    for base in range(0, len(data), WINDOW):
        for last, (kind, n) in search.iter(data[base : base + WINDOW + over].decode("latin-1")):
            at = base + last - n + 1 - 4 * (kind == "ftyp")
            if at >= 0 and at not in out and (found := CHECKS[kind](b, at)):
                out[at] = (at, *found)
    return [out[k] for k in sorted(out)]


def sniffed(media: Column, declared: Column) -> Column:
    """A struct column: the confirmed type of a media cell (null where nothing known begins at its first byte), whether
    the declared type was right, its length, where its samples are (WAVE) and all embedded files.

    Null or empty media: null type, declared_ok false, length 0, nothing embedded. A null declaration is never right.
    """
    from pyspark.sql.functions import arrow_udf

    @arrow_udf(SNIFFED)
    def run(cells, said):
        import pyarrow as pa

        search, out = automaton(), []
        for cell, name in zip(cells, said, strict=True):
            found = sniff(cell.as_py(), search)
            top = found[0] if found and found[0][0] == 0 else None
            out.append({
                "mime": top and top[1], "declared_ok": bool(top) and top[1] == name.as_py(), "length": top[2] if top else 0,
                "payload_offset": top[3] if top and len(top) > 3 else None, "payload_length": top[4] if top and len(top) > 3 else None,
                "embedded": [{"mime": x[1], "offset": x[0], "length": x[2]} for x in found if x[0]],
            })
        long = pa.int64()
        return pa.array(out, pa.struct([
            ("mime", pa.string()), ("declared_ok", pa.bool_()), ("length", long), ("payload_offset", long), ("payload_length", long),
            ("embedded", pa.list_(pa.struct([("mime", pa.string()), ("offset", long), ("length", long)]))),
        ]))

    return run(media, declared)


def sniff_media(df: DataFrame, media: str, declared: str, out: str = "sniffed") -> DataFrame:
    """df with the struct column of sniffed() added; a column of df with that name is replaced."""
    return df.withColumn(out, sniffed(F.col(media), F.col(declared)))


def corrected(df: DataFrame, media: str, declared: str, out: str = "corrected") -> DataFrame:
    """df with the type that each cell really has: the confirmed one, else the declared one where nothing known begins at the
    first byte. Null or empty media keep what was declared."""
    return df.withColumn(out, F.coalesce(sniffed(F.col(media), F.col(declared))["mime"], F.col(declared)))


def carve(df: DataFrame, media: str, sniffed_col: str = "sniffed") -> DataFrame:
    """One row for each embedded file, with df's other columns, and carved_mime, carved_offset, carved_length and carved (its
    bytes), which replace columns of these names. Media that are null, empty or without embedded files give no row; a file
    inside another embedded one is a row of its own; repeated rows give repeated files."""
    one = df.select(whole(df).alias("row"), F.col(media).alias("media"), F.explode(F.col(sniffed_col)["embedded"]).alias("file"))
    cut = F.substring("media", (F.col("file.offset") + 1).cast("int"), F.col("file.length").cast("int"))
    gone = {media.lower(), sniffed_col.lower(), "carved_mime", "carved_offset", "carved_length", "carved"}
    return one.select(*parts(df, "row", gone), F.col("file.mime").alias("carved_mime"), F.col("file.offset").alias("carved_offset"), F.col("file.length").alias("carved_length"), cut.alias("carved"))


def _le32(n: Column) -> Column:
    h = F.lpad(F.hex(n.cast("long")), 8, "0")
    return F.unhex(F.concat(*[F.substring(h, k, 2) for k in (7, 5, 3, 1)]))


def as_wav(payload: Column) -> Column:
    """8-bit mono samples, one a byte, in a WAVE file; all inside the JVM. Null stays null, no bytes give a file without samples."""
    n = F.octet_length(payload)
    fixed = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data"
    return F.concat(F.lit(b"RIFF"), _le32(n + 36), F.lit(fixed), _le32(n), payload)


def padded(text: Column) -> Column:
    """UTF-8 bytes and zeros up to a positive multiple of 64; null counts as empty."""
    raw = F.coalesce(text, F.lit("")).cast("binary")
    to = F.greatest(F.lit(64), F.ceil(F.octet_length(raw) / 64) * 64).cast("int")
    return F.rpad(raw, to, F.lit(bytes(1)))


def op1_media_columns(spark, sf_dir: str) -> DataFrame:
    """Every row of documents as a cell of samples; null texts as 64 zeros. declared_ok is false throughout, since cells are
    declared as plain bytes; `feature` has the corrected type."""
    docs = spread(table(spark, sf_dir, "documents"))
    stored = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), as_wav(padded(F.col("text"))).alias("media"), F.lit("application/octet-stream").alias("declared"))
    known = sniff_media(stored, "media", "declared")
    s = F.col("sniffed")
    back = known.withColumn("payload", F.substring("media", (s.payload_offset + 1).cast("int"), s.payload_length.cast("int")))
    inside = F.array_join(F.transform(s.embedded, lambda e: F.concat_ws(":", e.mime, e.offset.cast("string"), e.length.cast("string"))), ",")
    return back.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring(F.col("payload"), -64, 64)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat(s.mime, F.lit(";samples="), s.payload_length.cast("string"), F.lit(";embedded="), inside).alias("feature"),
        F.size(s.embedded).cast("long").alias("n_embedded"),
    )
