import hashlib
import random
import struct
import tracemalloc
import zlib

import numpy as np

from matchloom.llm import media, queries


def brute_thumbnail(blob):
    """A serial decoder of one grey baseline file with restart intervals: DC terms, one bit at a time."""
    frame = media.parse(blob)[0]
    codes = {}
    for k, table in frame.tables.items():
        code, at, codes[k] = 0, 16, {}
        for n in range(1, 17):
            for _ in range(table[n - 1]):
                codes[k][n, code] = table[at]
                code, at = code + 1, at + 1
            code <<= 1
    rows, columns = media.mcus(frame)
    values, data, total = [], frame.data, rows * columns
    parts, part, i = [], bytearray(), 0
    while i < len(data):
        if data[i] == 0xFF and i + 1 < len(data) and 0xD0 <= data[i + 1] <= 0xD7:
            parts.append(bytes(part))
            part, i = bytearray(), i + 2
            continue
        part.append(data[i])
        i += 2 if data[i] == 0xFF else 1
    parts.append(bytes(part))
    for part in parts:
        bits = "".join(f"{b:08b}" for b in part)
        at, pred = 0, 0

        def symbol(kind):
            nonlocal at
            code = 0
            for n in range(1, 17):
                code = code << 1 | int(bits[at])
                at += 1
                if (n, code) in codes[kind]:
                    return codes[kind][n, code]
            raise ValueError

        for _ in range(min(frame.interval or total, total - len(values))):
            size = symbol(0)
            v = int(bits[at : at + size] or "0", 2)
            at += size
            pred += v - (1 << size) + 1 if size and v < 1 << (size - 1) else v
            k = 1
            while k < 64:
                s = symbol(16)
                if s == 0:
                    break
                at += s & 15
                k += (s >> 4) + 1
            values.append(min(255, max(0, (pred * frame.quant[0] + 4 >> 3) + 128)))
    return bytes(values)


def file_with_detail(rng, width, height, interval):
    """A grey file whose blocks have AC terms, runs and ZRL codes, written bit by bit; and its DC terms."""
    dc, ac = {n: 4 for n in range(12)}, {0: 2, 0x01: 2, 0x12: 3, 0xF0: 4, 0x23: 4, 0x05: 5}
    dc_codes, ac_codes = media.canonical(dc), media.canonical(ac)
    rows, columns = -(-height // 8), -(-width // 8)
    out, bits, pred, terms = bytearray(), "", 0, []

    def flush():
        nonlocal bits
        bits += "1" * (-len(bits) % 8)
        for i in range(0, len(bits), 8):
            out.append(int(bits[i : i + 8], 2))
            if out[-1] == 0xFF:
                out.append(0)
        bits = ""

    def put(code, size):
        nonlocal bits
        bits += f"{code:0{size}b}" if size else ""

    for m in range(rows * columns):
        if interval and m and m % interval == 0:
            flush()
            out.extend([0xFF, 0xD0 + (m // interval - 1) % 8])
            pred = 0
        term = rng.randrange(-100, 100)
        terms.append(term)
        d, pred = term - pred, term
        size = abs(d).bit_length()
        put(*dc_codes[size])
        put(d if d >= 0 else d + (1 << size) - 1, size)
        k = 1
        while True:
            s = rng.choice([0, 0x01, 0x12, 0xF0, 0x23, 0x05])
            if s == 0xF0 and k + 16 > 62 or s not in (0, 0xF0) and k + (s >> 4) > 63:
                s = 0
            put(*ac_codes[s])
            if s == 0:
                break
            put(rng.randrange(1 << (s & 15)), s & 15)
            k += (s >> 4) + 1
            if k > 63:
                break
    flush()
    head = b"\xff\xd8" + media.segment(0xDB, bytes([0] + [3] * 64)) + media.segment(0xC0, struct.pack(">BHHBBBB", 8, height, width, 1, 1, 0x11, 0))
    head += media.dht(0, dc) + media.dht(16, ac) + (media.segment(0xDD, struct.pack(">H", interval)) if interval else b"") + media.segment(0xDA, bytes([1, 1, 0, 0, 63, 0]))
    return head + bytes(out) + b"\xff\xd9", np.clip((np.array(terms) * 3 + 4 >> 3) + 128, 0, 255).reshape(rows, columns)


def test_round_trip_is_lossless():
    rng = random.Random(1)
    texts = [b"", b"x", b"\xff\x00" * 300, bytes(range(256)) * 9, bytes(rng.randrange(256) for _ in range(5000)), b"prose and more prose " * 200, b"\xff" * 192]
    payloads = [media.pad(t) for t in texts]
    stored = media.encode(payloads)
    assert [b"".join(t.tobytes() for t in ts) for ts in media.thumbnails(stored)] == payloads
    assert [brute_thumbnail(s) for s in stored] == payloads


def test_a_long_payload_is_several_files():
    payload = media.pad(bytes(range(256)) * 6400)
    files = media.thumbnails(media.encode([payload]))[0]
    assert len(files) == 2 and b"".join(t.tobytes() for t in files) == payload


def test_memory_is_that_of_a_step():
    """Encoding and decoding hold the arrays of a few files, not of all that they are given."""
    rng = random.Random(3)
    payloads = [rng.randbytes(192 * 85) for _ in range(250)]  # 4 MB
    tracemalloc.start()
    try:
        stored = media.encode(payloads)
        encoding = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        held = tracemalloc.get_traced_memory()[0]
        found = media.thumbnails(stored)
        decoding = tracemalloc.get_traced_memory()[1] - held
    finally:
        tracemalloc.stop()
    assert [b"".join(t.tobytes() for t in ts) for ts in found] == payloads
    assert encoding < 70 << 20 and decoding < 50 << 20


def test_files_with_detail():
    rng = random.Random(2)
    made = [file_with_detail(rng, w, h, i) for w, h, i in ((64, 40, 0), (61, 33, 3), (200, 16, 7), (8, 8, 0), (64, 40, 5))]
    for blob, (own,) in zip([m[0] for m in made], media.thumbnails([m[0] for m in made])):
        expected = next(m[1] for m in made if m[0] == blob)
        assert (own == expected).all() and brute_thumbnail(blob) == expected.astype(np.uint8).tobytes()


def test_broken_media(spark):
    good = media.encode([media.pad(b"fine")])[0]
    rows = [(1, good, 4), (2, b"no jpeg", 3), (3, good[:-30], 4), (4, None, 0), (5, b"", 0), (None, good, None)]
    out = {r["id"]: r for r in media.described(spark.createDataFrame(rows, "id long, media binary, n_bytes long")).collect()}
    assert out[1]["payload_bytes"] == 192 and out[None]["payload_sha256"] == out[1]["payload_sha256"]
    assert out[2]["payload_bytes"] is None and out[2]["media_bytes"] == 7 and out[4]["media_bytes"] is None


def test_damaged_bytes_give_nulls_and_no_error(spark):
    good = media.encode([media.pad(b"fine and well")])[0]
    rows = [(i, good[:i] + bytes([v]) + good[i + 1 :], 13) for i in range(len(good) - 2) for v in (0x40, 0xFF, 0)]
    out = media.described(spark.createDataFrame(rows, "id long, media binary, n_bytes long")).collect()
    assert len(out) == len(rows) and all(r["media_bytes"] == len(good) for r in out)
    assert any(r["payload_bytes"] is None for r in out if r["id"] == 24)


def test_a_scan_for_each_component():
    """Two components, one scan each, with other tables before the second scan, in both orders."""
    a, b = media.pad(b"luminance " * 40), media.pad(b"another component " * 22)
    assert len(a) == len(b)
    rows = len(a) // media.COLUMNS
    scans = [x[len(media.header(rows)) : -2] for x in media.encode([a, b])]
    head = media.header(rows)
    frame = media.segment(0xC0, struct.pack(">BHHB", 8, rows * 8, media.COLUMNS * 8, 2) + bytes([1, 0x11, 0, 2, 0x11, 0]))
    start = head.index(b"\xff\xc0")
    head = head[:start] + frame + head[start + 13 : head.index(b"\xff\xda")]
    first, second = (media.segment(0xDA, bytes([1, n, 0, 0, 63, 0])) for n in (1, 2))
    other = media.dht(0x00, {i: 4 for i in range(12)}) + media.segment(0xDB, bytes([0] + [3] * 64))
    back = media.dht(0x00, media.DC_LENGTHS) + media.segment(0xDB, bytes([0] + [media.STEP] * 64))
    blobs = [head + first + scans[0] + other + second + scans[1] + b"\xff\xd9", head + other + second + scans[1] + back + first + scans[0] + b"\xff\xd9"]
    assert [t.tobytes() for (t,) in media.thumbnails(blobs)] == [a, a]


def check(rows, texts):
    for r, t in zip(rows, texts, strict=True):
        payload = media.pad((t or "").encode())
        assert (r["n_bytes"], r["payload_bytes"]) == (len((t or "").encode()), len(payload))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-16:])


def test_awkward_rows(docs, no_docs):
    rows = sorted(media.described(media.stored(docs)).collect(), key=lambda r: (str(r["id"]), r["n_bytes"]))
    texts = [r["text"] for r in sorted(docs.collect(), key=lambda r: (str(r["doc_id"]), len((r["text"] or "").encode())))]
    check(rows, texts)
    assert media.described(media.stored(no_docs)).count() == 0


def test_query(spark, small):
    rows = queries.op10_media(spark, small).orderBy("doc_id").collect()
    texts = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    check(rows, [r["text"] for r in texts])
    by = {}
    for r, t in zip(rows, texts):
        by.setdefault(t["text"], set()).add((r["media_sha256"], r["feature"]))
    assert all(len(x) == 1 for x in by.values())
