import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from placeflow.llm import media

Z = media.zigzag()

# The example code tables of the JPEG standard (annex K) for luminance; fixed values.
DC_COUNTS = bytes([0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0])
DC_SYMBOLS = bytes(range(12))


def ac_table():
    """A complete table over all run and size pairs: 8 bits each for half of them, longer ones for the rest."""
    symbols = [0x00, 0xF0] + [r << 4 | s for r in range(16) for s in range(1, 11)]
    counts = [0] * 16
    counts[7] = 100
    counts[8] = len(symbols) - 100
    return bytes(counts), bytes(symbols)


def codes(counts, symbols):
    out, code, k = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out[symbols[k]] = f"{code:0{length}b}"
            code, k = code + 1, k + 1
        code <<= 1
    return out


def bits(v):
    size = abs(v).bit_length()
    return size, f"{(v if v > 0 else v + (1 << size) - 1):0{size}b}" if size else ""


def encode(blocks, order, width, height, parts, steps, restart=0):
    """A plain sequential encoder of quantised blocks (zigzag order), MCU by MCU."""
    ac = ac_table()
    dc_codes, ac_codes = codes(DC_COUNTS, DC_SYMBOLS), codes(*ac)
    scan, pred, out = b"", Counter(), ""
    per = len(order)

    def flush(text):
        text += "1" * (-len(text) % 8)
        return int(text, 2).to_bytes(len(text) // 8, "big").replace(b"\xff", b"\xff\x00") if text else b""

    for i, b in enumerate(blocks):
        mcu = i // per
        if restart and i % per == 0 and mcu and mcu % restart == 0:
            scan += flush(out) + bytes([0xFF, 0xD0 + (mcu // restart - 1) % 8])
            out, pred = "", Counter()
        c = order[i % per]
        size, tail = bits(int(b[0]) - pred[c])
        pred[c] = int(b[0])
        out += dc_codes[size] + tail
        run = 0
        last = max((k for k in range(1, 64) if b[k]), default=0)
        for k in range(1, last + 1):
            if not b[k]:
                run += 1
                continue
            while run > 15:
                out += ac_codes[0xF0]
                run -= 16
            size, tail = bits(int(b[k]))
            out += ac_codes[run << 4 | size] + tail
            run = 0
        if last < 63:
            out += ac_codes[0]
    scan += flush(out)
    seg = media._segment
    head = b"\xff\xd8" + seg(0xE0, b"JFIF\0" + bytes(9)) + seg(media.DQT, bytes([0, *steps]))
    head += seg(media.SOF0, bytes([8]) + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([len(parts)]) + b"".join(bytes([i, h << 4 | v, 0]) for i, h, v in parts))
    head += seg(media.DHT, bytes([0x00]) + DC_COUNTS + DC_SYMBOLS) + seg(media.DHT, bytes([0x10]) + ac[0] + ac[1])
    if restart:
        head += seg(media.DRI, restart.to_bytes(2, "big"))
    head += seg(media.SOS, bytes([len(parts)]) + b"".join(bytes([i, 0]) for i, _, _ in parts) + bytes([0, 63, 0]))
    return head + scan + b"\xff\xd9"


def blocks_of(r, n):
    b = np.where(r.random((n, 64)) < 0.15, r.integers(-1023, 1024, (n, 64)), 0)
    b[:, 0] = np.clip(r.integers(-500, 500, n), -1023, 1023)
    return b


@pytest.mark.parametrize("restart", [0, 1, 3])
@pytest.mark.parametrize("parts", [[(1, 1, 1)], [(1, 2, 2), (2, 1, 1), (3, 1, 1)]])
def test_decoder_on_general_files(restart, parts):
    r = np.random.default_rng(restart + len(parts))
    steps = [8, *r.integers(1, 30, 63).tolist()]
    order = [0] if len(parts) == 1 else [0, 0, 0, 0, 1, 2]
    width, height = 70, 43
    side = 8 if len(parts) == 1 else 16
    n = -(-width // side) * -(-height // side) * len(order)
    many = [blocks_of(r, n) for _ in range(3)]
    files = [media.Jpeg.parse(encode(b, order, width, height, parts, steps, restart)) for b in many]
    for b, f, c in zip(many, files, media.coefficients(files), strict=True):
        assert (f.width, f.height) == (width, height) and (c == b).all()
        thumb = media.luminance(f, c)
        # the mean of the block's pixels, by the inverse transform: only the first coefficient has one
        want = np.clip((b[:, 0] * 8 + 4) // 8 + 128, 0, 255)
        if len(parts) == 1:
            assert (thumb == want.reshape(thumb.shape)).all()
        else:
            own = want.reshape(-1, 6)[:, :4].reshape(-(-height // 16), -(-width // 16), 2, 2)
            assert all(thumb[2 * y + i, 2 * x + j] == own[y, x, i, j] for y in range(own.shape[0]) for x in range(own.shape[1]) for i in (0, 1) for j in (0, 1))


@pytest.mark.parametrize("first", [0, 1, 2])
@pytest.mark.parametrize("restart", [0, 2])
def test_a_scan_for_each_component(first, restart):
    """Components in scans of their own, the first one at any place; edges that its blocks don't fill."""
    r = np.random.default_rng(first)
    steps, (width, height), parts = [8, *[3] * 63], (70, 43), [(1, 2, 2), (2, 1, 1), (3, 1, 1)]
    whole = encode(np.zeros((0, 64)), [0], width, height, parts, steps, restart)
    files, want = [], blocks_of(r, 9 * 6)
    for i, n in ((1, 9 * 6), (2, 5 * 3), (3, 5 * 3)):  # blocks that hold a sample
        one = encode(want if i == 1 else blocks_of(r, n), [0], width, height, [(i, 1, 1)], steps, restart)
        files.append(one[one.index(b"\xff\xda") : -2])
    files.insert(first, files.pop(0))
    file = media.Jpeg.parse(whole[: whole.index(b"\xff\xda")] + b"".join(files) + b"\xff\xd9")
    (got,) = media.coefficients([file])
    assert (got == want).all() and (file.across, file.down) == (9, 6)
    assert (media.luminance(file, got) == np.clip(want[:, 0] + 128, 0, 255).reshape(6, 9)).all()


def test_scans_without_the_first_component_are_refused():
    whole = encode(blocks_of(np.random.default_rng(1), 15), [0], 70, 43, [(2, 1, 1)], [8, *[3] * 63])
    head, scan = whole[: whole.index(b"\xff\xc0")], whole[whole.index(b"\xff\xda") :]
    frame = media._segment(media.SOF0, bytes([8, 0, 43, 0, 70, 2, 1, 0x11, 0, 2, 0x11, 0]))
    rest = whole[whole.index(b"\xff\xc4") : whole.index(b"\xff\xda")]
    for tail in (scan, scan[:-2], scan[:2] + b"\0\x05\x05" + scan[5:]):
        with pytest.raises((ValueError, KeyError)):
            media.Jpeg.parse(head + frame + rest + tail)


def test_zigzag():
    assert Z[:10].tolist() == [0, 1, 8, 16, 9, 2, 3, 10, 17, 24] and sorted(Z.tolist()) == list(range(64)) and Z[-1] == 63


def test_payload_round_trip():
    r = np.random.default_rng(7)
    payloads = [media.pad(x) for x in (b"", b"abc", b"\xff" * 2000, r.bytes(5000), bytes(range(256)) * 9, r.bytes(576 * 9000))]
    files = [media.Jpeg.parse(x) for x in media.wrap(payloads)]
    assert [media.unwrap(f, c) for f, c in zip(files, media.coefficients(files), strict=True)] == payloads
    assert [len(p) % 576 for p in payloads] == [0] * 6 and len(payloads[0]) == 576


def test_stored_documents(spark, docs, rows, none, clashing):
    from placeflow.llm.common import columns

    run = lambda d: columns(d, "doc_id", "text").mapInArrow(media.stored, media.SCHEMA)
    got = Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in run(docs).collect())
    want = Counter()
    for r in rows:
        b = (r[1] or "").encode()
        p = b + b"\xff" * (max(1, -(-len(b) // 576)) * 576 - len(b))
        want[(r[0], len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))] += 1
    assert got == want and run(none).count() == 0 and run(clashing).count() == len(rows)
    same = {r.media_sha256 + r.feature for r in run(docs.filter("text IS NULL OR text = ''")).collect()}
    assert len(same) == 1


def test_images_that_cannot_be_read(spark):
    good = encode(blocks_of(np.random.default_rng(1), 4), [0], 16, 16, [(1, 1, 1)], [1] * 64)
    rows = [(1, good), (2, None), (3, b""), (4, good[:-60]), (5, b"\xff\xd8\xff\xc2\x00\x04ab"), (6, good.replace(b"\xff\xc0", b"\xff\xc2", 1)), (7, good[:30])]
    df = spark.createDataFrame([(i, bytearray(b) if b is not None else None) for i, b in rows], "id int, image binary")
    got = {r.id: r for r in media.thumbnails(df).collect()}
    assert got[1].error is None and (got[1].width, got[1].height) == (16, 16) and len(got[1].thumbnail) == 4 and len(got[1].thumbnail_hash) == 16
    assert all(got[i].error and got[i].width is None for i in range(2, 8))


def test_broken_images_leave_the_others_alone(spark):
    """No quantiser, a code table with too few symbols, sampling factor 0, a size that the data can't hold; clashing columns."""
    whole = encode(blocks_of(np.random.default_rng(1), 4), [0], 16, 16, [(1, 1, 1)], [1] * 64)

    def without(marker):
        i = whole.index(bytes([0xFF, marker]))
        return whole[:i] + whole[i + 2 + int.from_bytes(whole[i + 2 : i + 4], "big") :]

    at = whole.index(b"\xff\xc0")
    frame = lambda i, b: whole[: at + i] + b + whole[at + i + len(b) :]
    table = whole.index(b"\xff\xc4")
    short = bytearray(whole)
    short[table + 5] = 40  # more codes than symbols
    bad = [without(0xDB), bytes(short), frame(11, b"\x00"), frame(11, b"\x01"), frame(5, b"\xff\xff\xff\xff")]
    rows = [(i, b) for i, b in enumerate([whole, *bad, whole])]
    df = spark.createDataFrame([(i, bytearray(b), "x", "y", 3) for i, b in rows], "id int, image binary, _t string, error string, width int").coalesce(1)
    out = media.thumbnails(df)
    assert out.columns == ["id", "image", "_t", "width", "height", "thumbnail", "thumbnail_hash", "error"]
    got = {r.id: r for r in out.collect()}
    assert all(got[i].error is None and got[i].width == 16 and got[i]._t == "x" for i in (0, 6))
    assert all(got[i].error and got[i].width is None for i in range(1, 6))
    assert media.thumbnails(df.limit(0)).count() == 0


def test_long_texts_are_stored_in_portions(monkeypatch):
    payloads = [media.pad(x) for x in (np.random.default_rng(3).bytes(7000), b"abc")]
    whole = media.wrap(payloads)
    monkeypatch.setattr(media, "PORTION", 7)
    assert media.wrap(payloads) == whole
    files = [media.Jpeg.parse(x) for x in whole]
    assert [media.unwrap(f, c) for f, c in zip(files, media.coefficients(files), strict=True)] == payloads
