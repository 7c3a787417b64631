"""Operator 3: baseline JPEG columns.

`Jpeg` parses the markers of a baseline file; `coefficients` Huffman-decodes
the scans of many files at once; `luminance` makes the DC-only thumbnail (one
pixel for each 8x8 block of the first component) in numpy. `thumbnails` runs
them over a binary column and stores dimensions and a thumbnail hash.

Decoding is lockstep: every restart segment is independent, so all segments of
all files with the same tables and block order advance by one Huffman symbol
per numpy step. A file without restart intervals is one segment, still right.

`wrap` stores arbitrary bytes losslessly as quantised coefficients: 64 bytes a
block, zigzag order, one restart interval per block. Amplitudes of size 8 are
exactly 256, and JPEG writes their eight bits as the byte itself, so with a
one-bit code for that symbol a block takes 72 bytes. The comment segment holds
the payload's length, as whole rows of blocks may need more. `unwrap` reads the
payload back from decoded coefficients.

Nulls: a null text is an empty one; null or broken images give null columns and
an error text, never an exception, and don't touch the other images. Equal
texts give equal values, so repeated rows do. A very long text is written and
read in portions of blocks; held at once are some four times its bytes. An
empty table gives no rows; extra columns are ignored by the query and kept by
`thumbnails`, except those that have the names of its results.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from placeflow.llm.common import chunks, columns, raw, table

UNIT = 576
#: Blocks in a row of a stored payload, and the most that a side may have.
ROW, SIDE = 3, 8191
#: Blocks that are written, and restart segments that are decoded, at once.
PORTION = 16_384
#: DC quantiser of stored payloads: coefficients of +-255 then span the pixel range.
DC_STEP = 4

# Fixed values of the format (markers and segment codes).
SOI, EOI, SOF0, SOF1, DHT, DQT, DRI, SOS, COM, RST0 = 0xD8, 0xD9, 0xC0, 0xC1, 0xC4, 0xDB, 0xDD, 0xDA, 0xFE, 0xD0


def zigzag() -> np.ndarray:
    """Natural index of each zigzag position of an 8x8 block."""
    cells = sorted(((i + j, i if (i + j) % 2 else j, i, j) for i in range(8) for j in range(8)))
    return np.array([i * 8 + j for _, _, i, j in cells])


#: The end of a scan: a marker other than a restart (and than a stuffed zero, which is none).
_MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")


@dataclass
class Jpeg:
    """Parsed markers of a baseline file, and the scan that holds the first component (alone, or among others)."""

    width: int = 0
    height: int = 0
    parts: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, h, v, quantiser
    steps: dict[int, np.ndarray] = field(default_factory=dict)  # quantisers in zigzag order
    codes: dict[int, tuple[bytes, bytes]] = field(default_factory=dict)  # class*16+id: counts, symbols
    restart: int = 0
    order: list[tuple[int, int, int]] = field(default_factory=list)  # component index, DC and AC table, per block of an MCU
    mcus: int = 0
    comment: bytes = b""
    data: bytes = b""

    @classmethod
    def parse(cls, b: bytes) -> Jpeg:
        if b[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG")
        out, i = cls(), 2
        while True:
            if i + 4 > len(b) or b[i] != 0xFF:
                raise ValueError("broken marker")
            m = b[i + 1]
            if m == 0xFF:  # fill byte
                i += 1
                continue
            if m == EOI:
                raise ValueError("no scan")
            n = int.from_bytes(b[i + 2 : i + 4], "big")
            s = b[i + 4 : i + 2 + n]
            if n < 2 or len(s) != n - 2:
                raise ValueError("short segment")
            i += 2 + n
            if m in (SOF0, SOF1):
                if s[0] != 8:
                    raise ValueError("sample precision is not 8 bits")
                out.height, out.width = int.from_bytes(s[1:3], "big"), int.from_bytes(s[3:5], "big")
                out.parts = [(s[k], s[k + 1] >> 4, s[k + 1] & 15, s[k + 2]) for k in range(6, 6 + 3 * s[5], 3)]
            elif 0xC0 <= m <= 0xCF and m not in (DHT, 0xC8, 0xCC):
                raise ValueError("not a baseline file")
            elif m == DHT:
                k = 0
                while k < len(s):
                    counts = s[k + 1 : k + 17]
                    symbols = s[k + 17 : k + 17 + sum(counts)]
                    if len(counts) < 16 or len(symbols) < sum(counts):
                        raise ValueError("short code table")
                    out.codes[s[k]] = counts, symbols
                    k += 17 + sum(counts)
            elif m == DQT:
                k = 0
                while k < len(s):
                    wide = s[k] >> 4
                    size = 128 if wide else 64
                    if len(s) < k + 1 + size:
                        raise ValueError("short quantiser")
                    out.steps[s[k] & 15] = np.frombuffer(s[k + 1 : k + 1 + size], ">u2" if wide else "u1").astype(np.int32)
                    k += 1 + size
            elif m == DRI:
                out.restart = int.from_bytes(s[:2], "big")
            elif m == COM:
                out.comment = s
            elif m == SOS:
                whole = s[:1] == bytes([len(out.parts)])
                after = None if whole else _MARKER.search(b, i)
                end = b.rfind(b"\xff\xd9") if whole else after.start() if after else len(b)
                if out._scan(s):
                    out.data = b[i : end if end >= i else len(b)]
                    return out
                i = end  # other components' scan

    def _scan(self, s: bytes) -> bool:
        """Takes up the scan, if it has the first component."""
        if not self.parts or not self.width or not self.height:
            raise ValueError("no frame")
        if not s or not 1 <= s[0] <= len(self.parts) or len(s) < 1 + 2 * s[0]:
            raise ValueError("broken scan")
        if any(not 1 <= p[1] <= 4 or not 1 <= p[2] <= 4 for p in self.parts):
            raise ValueError("sampling factor")
        if any(p[3] not in self.steps for p in self.parts):
            raise ValueError("a quantiser is missing")
        index = {p[0]: k for k, p in enumerate(self.parts)}
        own = [(index[s[1 + 2 * k]], s[2 + 2 * k]) for k in range(s[0])]
        if all(c for c, _ in own):
            return False
        one = len(own) == 1
        for c, t in own:
            blocks = 1 if one else self.parts[c][1] * self.parts[c][2]
            self.order += [(c, t >> 4, 16 + (t & 15))] * blocks
        for _, dc, ac in self.order:
            if dc not in self.codes or ac not in self.codes:
                raise ValueError("a code table is missing")
        h, v = max(p[1] for p in self.parts), max(p[2] for p in self.parts)
        if one:  # blocks that the image doesn't reach are left out, other than in interleaved scans
            across, down = -(-self.width * self.parts[0][1] // h), -(-self.height * self.parts[0][2] // v)
            h, v = 1, 1
        else:
            across, down = self.width, self.height
        self.across, self.down = -(-across // (8 * h)), -(-down // (8 * v))
        self.mcus = self.across * self.down
        return True

    def segments(self) -> list[np.ndarray]:
        """The restart segments' bytes, without stuffed zeros and markers."""
        d = np.frombuffer(self.data, np.uint8)
        at = np.flatnonzero(d[:-1] == 0xFF) if len(d) > 1 else np.empty(0, int)
        after = d[at + 1]
        cuts = at[(after >= RST0) & (after < RST0 + 8)]
        drop = np.concatenate([at[after == 0] + 1, cuts, cuts + 1])
        keep = np.ones(len(d), dtype=bool)
        keep[drop] = False
        place = np.cumsum(keep)
        edges = [0, *(place[cuts]).tolist(), int(place[-1]) if len(d) else 0]
        d = d[keep]
        return [d[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def lookup(counts: bytes, symbols: bytes) -> np.ndarray:
    """Code length * 256 + symbol for each 16-bit window; 0: no code."""
    out, code, k = np.zeros(1 << 16, dtype=np.int32), 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            lo = code << (16 - length)
            out[lo : lo + (1 << (16 - length))] = length << 8 | symbols[k]
            code, k = code + 1, k + 1
        code <<= 1
    return out


def coefficients(files: list[Jpeg]) -> list[np.ndarray | None]:
    """Quantised coefficients [blocks, 64] in zigzag order of each file's scan; None where it is broken."""
    out: list[np.ndarray | None] = [None] * len(files)
    groups: dict[tuple, list[int]] = {}
    for k, f in enumerate(files):
        groups.setdefault((tuple(f.order), tuple(sorted(f.codes.items()))), []).append(k)
    for (order, codes), members in groups.items():
        lanes, owners, sizes, lengths = [], [], [], []
        for k in members:
            f = files[k]
            if f.mcus * len(order) > 4 * len(f.data):
                continue  # a block takes two bits at least; stays None
            per = f.restart or f.mcus
            found = f.segments()
            n = -(-f.mcus // per)
            if len(found) < n:
                continue  # stays None
            lanes += found[:n]
            owners += [k] * n
            sizes += [min(per, f.mcus - j * per) * len(order) for j in range(n)]
            lengths += [len(x) for x in found[:n]]
        if not lanes:
            continue
        some = [slice(i, i + PORTION) for i in range(0, len(lanes), PORTION)]
        parts = [_lockstep(lanes[i], np.array(sizes[i]), np.array(lengths[i]), order, dict(codes)) for i in some]
        blocks, good = (np.concatenate(x) if len(parts) > 1 else x[0] for x in zip(*parts, strict=True))
        starts, k = np.concatenate([[0], np.cumsum(sizes)]), 0
        while k < len(owners):
            n = k
            while n < len(owners) and owners[n] == owners[k]:
                n += 1
            if good[k:n].all():
                out[owners[k]] = blocks[starts[k] : starts[n]]
            k = n
    return out


def _lockstep(lanes: list[np.ndarray], sizes: np.ndarray, lengths: np.ndarray, order: tuple, codes: dict) -> tuple[np.ndarray, np.ndarray]:
    names = sorted({t for _, dc, ac in order for t in (dc, ac)})
    tables = np.concatenate([lookup(*codes[t]) for t in names])
    use = np.array([[names.index(dc), names.index(ac)] for _, dc, ac in order]) << 16
    part = np.array([c for c, _, _ in order])
    ends = np.cumsum(lengths)
    buf = np.concatenate([*lanes, np.full(16, 255, np.uint8)])
    view = np.ndarray((len(buf) - 7,), dtype=">u8", buffer=buf.data, strides=(1,))
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    out = np.zeros((int(sizes.sum()), 64), dtype=np.int16)
    flat = out.reshape(-1)
    good = np.ones(len(sizes), dtype=bool)

    lane = np.flatnonzero(sizes > 0)
    pos = (ends - lengths)[lane].astype(np.int64) * 8
    stop = ends[lane].astype(np.int64) * 8
    block = np.zeros(len(lane), dtype=np.int64)
    k = np.zeros(len(lane), dtype=np.int64)
    base, most = first[lane] * 64, sizes[lane]
    pred = np.zeros((len(lane), int(part.max()) + 1), dtype=np.int64)
    one = len(order) == 1
    while len(lane):
        turn = 0 if one else block % len(order)
        dc = k == 0
        w = view[pos >> 3].astype(np.uint64) << (pos & 7).astype(np.uint64)
        e = tables[np.where(dc, use[turn, 0], use[turn, 1]) + (w >> np.uint64(48)).astype(np.int64)]
        length, size = e >> 8, e & 15
        run = (e >> 4) & 15
        s = size.astype(np.uint64)
        amp = (((w << length.astype(np.uint64)) >> np.uint64(1)) >> (np.uint64(63) - s)).astype(np.int64)
        full = np.int64(1) << size
        value = np.where(2 * amp < full, amp - full + 1, amp)
        value[size == 0] = 0
        pos = pos + length + size
        skip = np.where(dc, 0, np.where(size == 0, np.where(run == 15, 15, 63), run))
        k = k + skip
        bad = (length == 0) | (pos > stop) | ((k > 63) & (size > 0))
        if dc.any():
            comp = 0 if one else part[turn]
            if one:
                pred[dc, 0] += value[dc]
                value = np.where(dc, pred[:, 0], value)
            else:
                rows = np.flatnonzero(dc)
                pred[rows, comp[rows]] += value[rows]
                value[rows] = pred[rows, comp[rows]]
        put = (dc | (size > 0)) & ~bad
        flat[(base + block * 64 + np.minimum(k, 63))[put]] = value[put]
        k += 1
        over = k > 63
        block = block + over
        k[over] = 0
        if bad.any() or over.any():
            good[lane[bad]] = False
            live = ~bad & (block < most)
            if not live.all():
                lane, pos, stop, block, k, base, most, pred = (x[live] for x in (lane, pos, stop, block, k, base, most, pred))
    return out, good


def luminance(f: Jpeg, blocks: np.ndarray) -> np.ndarray:
    """The DC-only thumbnail of the first component: a byte for each of its blocks."""
    own = [i for i, (c, _, _) in enumerate(f.order) if c == 0]
    dc = blocks[:, 0].reshape(f.mcus, len(f.order))[:, own].astype(np.int64) * int(f.steps[f.parts[0][3]][0])
    h, v = (1, 1) if len(f.order) == 1 else f.parts[0][1:3]
    grid = dc.reshape(f.down, f.across, v, h).transpose(0, 2, 1, 3).reshape(f.down * v, f.across * h)
    return np.clip((grid + 4) // 8 + 128, 0, 255).astype(np.uint8)


def average_hash(image: np.ndarray, side: int = 8) -> str:
    """Hex of which cells of a side x side grid are over the mean; cells are sampled by nearest block, sums along long sides."""
    def shrink(x: np.ndarray) -> np.ndarray:
        n = len(x)
        at = np.arange(side) * n // side
        return np.add.reduceat(x, at, axis=0) / np.maximum(np.diff(np.append(at, n)), 1).reshape(-1, 1) if n >= side else x[at].astype(float)

    cells = shrink(shrink(image.astype(np.int64)).T).T
    return np.packbits(cells.ravel() > cells.mean()).tobytes().hex()


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


#: One-bit code for size 8; in the AC table also end of block and sixteen zeros.
_DC_CODES = bytes([0x00, 1, *[0] * 15, 8])
_AC_CODES = bytes([0x10, 1, 1, 1, *[0] * 13, 0x08, 0x00, 0xF0])


def pad(text: bytes, unit: int = UNIT) -> bytes:
    return text + b"\xff" * (max(1, -(-len(text) // unit)) * unit - len(text))


def wrap(payloads: list[bytes]) -> list[bytes]:
    """Baseline files whose quantised coefficients are the payloads' bytes (lengths are multiples of 64)."""
    out = []
    for p in payloads:
        n = len(p) // 64
        across = ROW * -(-n // (ROW * SIDE))
        down = -(-n // across)
        b = np.frombuffer(p + b"\xff" * ((across * down - n) * 64), np.uint8).reshape(-1, 64)
        rows = np.empty((len(b), 74), dtype=np.uint8)
        for i in range(0, len(b), PORTION):
            some = b[i : i + PORTION]
            bits = np.zeros((len(some), 64, 9), dtype=np.uint8)
            bits[:, :, 1:] = np.unpackbits(some, axis=1).reshape(-1, 64, 8)
            rows[i : i + PORTION, :72] = np.packbits(bits.reshape(len(some), 576), axis=1)
        full = np.flatnonzero(rows[:, :72] == 255)
        rows[:, 72] = 0xFF
        rows[:, 73] = RST0 + np.arange(len(b)) % 8
        scan = rows.reshape(-1)[:-2]
        if len(full):
            scan = np.insert(scan, full // 72 * 74 + full % 72 + 1, 0)
        head = b"".join((
            b"\xff\xd8",
            _segment(COM, len(p).to_bytes(8, "big")),
            _segment(DQT, bytes([0, DC_STEP, *[1] * 63])),
            _segment(SOF0, bytes([8]) + (8 * down).to_bytes(2, "big") + (8 * across).to_bytes(2, "big") + bytes([1, 1, 0x11, 0])),
            _segment(DHT, _DC_CODES), _segment(DHT, _AC_CODES), _segment(DRI, (1).to_bytes(2, "big")),
            _segment(SOS, bytes([1, 1, 0x00, 0, 63, 0])),
        ))
        out.append(head + scan.tobytes() + b"\xff\xd9")
    return out


def unwrap(f: Jpeg, blocks: np.ndarray) -> bytes:
    """The payload that `wrap` stored."""
    flat = blocks.reshape(-1)
    return np.where(flat < 0, flat + 255, flat).astype(np.uint8).tobytes()[: int.from_bytes(f.comment, "big")]


def feature(f: Jpeg, blocks: np.ndarray) -> str:
    return f"{f.width}x{f.height}:{average_hash(luminance(f, blocks))}"


_KINDS = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string()}
SCHEMA = ", ".join(f"{k} {'string' if t == pa.string() else 'bigint'}" for k, t in _KINDS.items())


def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, limit=1_500_000):
        texts = [t or b"" for t in raw(batch.column("text"))]
        media = wrap([pad(t) for t in texts])
        files = [Jpeg.parse(m) for m in media]
        rows = []
        for key, t, m, f, c in zip(batch.column("doc_id").to_pylist(), texts, media, files, coefficients(files), strict=True):
            p = unwrap(f, c)
            rows.append((key, len(t), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(m), hashlib.sha256(m).hexdigest(), feature(f, c)))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS.values(), strict=True)], names=list(_KINDS))


def thumbnail(f: Jpeg, blocks: np.ndarray) -> tuple:
    t = luminance(f, blocks)
    return f.width, f.height, t.tobytes(), average_hash(t), None


_BROKEN = (ValueError, IndexError, KeyError, ZeroDivisionError, OverflowError)


def _images(blobs: list[bytes | None]) -> list[tuple]:
    """Width, height, thumbnail, hash and error of each image."""
    out: list = [(None, None, None, None, "null")] * len(blobs)
    good: dict[int, Jpeg] = {}
    for i, b in enumerate(blobs):
        try:
            if b is not None:
                good[i] = Jpeg.parse(b)
        except _BROKEN as e:
            out[i] = (None, None, None, None, str(e) or "broken")
    try:
        blocks = coefficients(list(good.values()))
    except _BROKEN:  # one of them: each by itself
        blocks = []
        for f in good.values():
            try:
                blocks += coefficients([f])
            except _BROKEN:
                blocks.append(None)
    for (i, f), c in zip(good.items(), blocks, strict=True):
        try:
            out[i] = thumbnail(f, c) if c is not None else (None, None, None, None, "broken scan")
        except _BROKEN as e:
            out[i] = (None, None, None, None, str(e) or "broken")
    return out


def thumbnails(images: DataFrame, column: str = "image") -> DataFrame:
    """images with width, height, thumbnail (bytes, a row of blocks after the other), its hash, and error; columns of these names are replaced."""
    from pyspark.sql import functions as F

    names = ["width", "height", "thumbnail", "thumbnail_hash", "error"]

    @F.pandas_udf("width int, height int, thumbnail binary, thumbnail_hash string, error string")
    def read(blobs):
        import pandas as pd

        rows = _images([None if b is None else bytes(b) for b in blobs])
        return pd.DataFrame(rows, columns=names).astype({"width": "Int32", "height": "Int32"})

    made = "_t" * (1 + max((len(c) for c in images.columns), default=0))  # longer than any name there is
    kept = [F.col(f"`{c}`") for c in images.columns if c not in names]
    return images.select(*kept, read(F.col(f"`{column}`")).alias(made)).select("*", f"{made}.*").drop(made)


def op3_jpeg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns(table(spark, sf_dir, "documents"), "doc_id", "text").mapInArrow(stored, SCHEMA)
