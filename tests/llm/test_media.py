import binascii
import gzip
import hashlib
import io
import struct
import zipfile
import zlib

import pytest

from tessera.llm import media
from tests.llm.helpers import documents, saved, words


def png():
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", binascii.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(b"\0\0")) + part(b"IEND", b"")


def ogg():
    head = b"OggS\0\x06" + bytes(8) + struct.pack("<II", 5, 0)
    page = head + bytes(4) + b"\x01\x03abc"
    return head + struct.pack("<I", media._ogg_crc(page)) + b"\x01\x03abc"


def zipped():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.txt", "hello")
    return out.getvalue()


def wav(payload):
    return b"RIFF" + struct.pack("<I", 36 + len(payload)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 8000, 1, 8) + b"data" + struct.pack("<I", len(payload)) + payload


FILES = {
    "image/png": png(),
    "image/gif": b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + bytes(6) + b"\x2c" + struct.pack("<HHHHB", 0, 0, 1, 1, 0) + b"\x02\x02\x4c\x01\0\x3b",
    "image/jpeg": b"\xff\xd8\xff\xe0\0\x04ab\xff\xc0\0\x0b\x08\0\x01\0\x01\x01\x01\x11\0\xff\xda\0\x08\x01\x01\0\0\x3f\0\x12\x34\xff\xd9",
    "image/bmp": b"BM" + struct.pack("<IIIIiiHHIIiiII", 58, 0, 54, 40, 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + bytes(4),
    "audio/wav": wav(bytes(64)),
    "image/webp": b"RIFF" + struct.pack("<I", 16) + b"WEBPVP8L" + struct.pack("<I", 4) + b"\x2f\0\0\0",
    "audio/ogg": ogg(),
    "application/pdf": b"%PDF-1.4\nstartxref\n0\n%%EOF",
    "application/zip": zipped(),
    "application/gzip": gzip.compress(b"hello hello hello", mtime=0),
    "video/mp4": struct.pack(">I", 16) + b"ftypisom" + bytes(4) + struct.pack(">I", 12) + b"mdatabcd",
}


@pytest.mark.parametrize("mime", sorted(FILES))
def test_a_file_is_confirmed_with_its_length_anywhere(mime):
    data = FILES[mime]
    assert media.sniff(data)[0][:3] == (0, mime, len(data))
    assert (5, mime, len(data)) in [x[:3] for x in media.sniff(b"\1\2\3\4\5" + data + b"\0\0\0tail")]


@pytest.mark.parametrize("mime", sorted(FILES))
def test_a_file_cut_short_is_refused(mime):
    assert not [x for x in media.sniff(FILES[mime][:-2]) if x[0] == 0]


def test_magic_bytes_alone_are_no_file():
    assert media.sniff(b"".join(m for _, m in media.MAGIC) + b"BM %PDF- RIFF ftyp" * 50) == []


def test_embedded_files_are_carved_and_types_corrected(spark):
    whole = wav(b"..." + png() + bytes(64))
    df = spark.createDataFrame([(1, bytearray(whole), "image/png", "a"), (2, bytearray(png()), "image/png", "b"), (3, None, None, "c"), (4, bytearray(b""), "x", "d")], "id int, media binary, said string, __file string")
    out = {r["id"]: r["sniffed"] for r in media.sniff_media(df, "media", "said").collect()}
    assert out[1]["mime"] == "audio/wav" and not out[1]["declared_ok"] and out[1]["payload_offset"] == 44
    assert out[2]["mime"] == "image/png" and out[2]["declared_ok"] and not out[2]["embedded"]
    assert out[3]["mime"] is None and out[4]["length"] == 0
    known = media.sniff_media(df.drop("__file").withColumnRenamed("said", "said"), "media", "said")
    files = media.carve(known, "media").collect()
    assert [(r["id"], r["carved_mime"], bytes(r["carved"])) for r in files] == [(1, "image/png", png())]


def test_query_round_trip(spark, tmp_path):
    texts = [(1, None), (2, ""), (3, "a" * 64), (4, "é" * 40), (5, words(1, 60_000)), (6, "x\0y"), (6, "x\0y"), (None, "BM GIF89a")]
    sf = saved(spark, tmp_path, documents=documents(spark, texts))
    rows = media.op1_media_columns(spark, sf).collect()
    assert len(rows) == len(texts)
    got = sorted(((r["doc_id"] or 0, r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["media_bytes"], r["media_sha256"]) for r in rows))
    want = []
    for k, t in texts:
        raw = (t or "").encode()
        full = raw + bytes(-len(raw) % 64) if raw else bytes(64)
        want.append((k or 0, len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]), len(full) + 44, hashlib.sha256(wav(full)).hexdigest()))
    assert got == sorted(want)


def test_query_on_no_documents(spark, tmp_path):
    assert media.op1_media_columns(spark, saved(spark, tmp_path, documents=documents(spark, []))).count() == 0


def test_files_with_several_end_markers_are_whole():
    first = b"%PDF-1.4\nstartxref\n0\n%%EOF"
    pdf = first + b"\nmore\nstartxref\n116\n%%EOF\nupdate\nstartxref\n220\r\n%%EOF"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a.zip", zipped())
        z.writestr("b.zip", zipped())
    gz = b"".join(gzip.compress(x, mtime=0) for x in (b"one", b"two" * 99, b""))
    for mime, data in (("application/pdf", pdf), ("application/zip", out.getvalue()), ("application/gzip", gz)):
        for pre, post in ((b"", b""), (b"junk", b" %%EOF tail")):
            assert (len(pre), mime, len(data)) in [x[:3] for x in media.sniff(pre + data + post)], mime
    assert [x[:3] for x in media.sniff(pdf + first)] == [(0, "application/pdf", len(pdf)), (len(pdf), "application/pdf", len(first))]
    assert media.sniff(gz + gz[:15])[0][:3] == (0, "application/gzip", len(gz))


def test_an_mp4_whose_last_box_is_open(spark):
    box = lambda kind, body: (8 + len(body)).to_bytes(4, "big") + kind + body
    head = box(b"ftyp", b"isom\0\0\0\0isom")
    assert media.sniff(head + b"\0\0\0\0mdat" + b"x" * 50) == [(0, "video/mp4", len(head) + 58)]
    assert media.sniff(head + b"\0\0\0\0junk") == []


def test_many_ftyp_boxes_stay_linear():
    import time

    data = (b"\0\0\0\x10ftypisom\0\0\0\0") * 300_000
    begin = time.monotonic()
    assert media.sniff(data + b"\0\0\0\x08mdat")[0] == (0, "video/mp4", len(data) + 8)
    assert media.sniff(data) == []
    assert time.monotonic() - begin < 10


def test_corrected_types_and_any_names_of_columns(spark):
    png = b"\x89PNG\r\n\x1a\n"
    import struct
    import zlib

    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    png += chunk(b"IHDR", bytes(13)) + chunk(b"IEND", b"")
    df = spark.createDataFrame([(1, bytearray(png), "text/plain", "c", 5), (2, bytearray(b"words " + png), "text/plain", "c", 5), (3, None, "a/b", "c", 5)], "id int, cell binary, said string, carved string, __file int")
    assert [r["corrected"] for r in media.corrected(df, "cell", "said").orderBy("id").collect()] == ["image/png", "text/plain", "a/b"]
    out = media.carve(media.sniff_media(df, "cell", "said"), "cell")
    assert out.columns == ["id", "said", "__file", "carved_mime", "carved_offset", "carved_length", "carved"]
    assert [(r["id"], r["__file"], r["carved_mime"], r["carved_offset"], bytes(r["carved"])) for r in out.collect()] == [(2, 5, "image/png", 6, png)]
