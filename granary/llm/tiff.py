"""TIFF in a binary column: write 8-bit grey images, walk directories, decode every page.

Formats: little or big endian, strips or tiles, no compression, PackBits, LZW or deflate,
horizontal differencing; one row per page.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the format: compression schemes and tags.
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_AT, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_BYTES = 284, 317, 322, 323, 324, 325

#: Width of a stored payload in pixels, rows of a page, rows of a strip, side of a tile.
PAGE_WIDTH, PAGE_ROWS, STRIP_ROWS, TILE_SIDE = 64, 1024, 128, 32
#: Bytes of pixels in an output batch.
OUT_BYTES = 4 << 20
#: Most bytes that any scheme makes of one byte: a larger page is a fault of its directory.
RATIO = 4096


@dataclass(frozen=True)
class Layout:
    compression: int = DEFLATE
    predictor: bool = False
    tiled: bool = False


#: Layouts that stored payloads take in turn, by the payload's own checksum.
LAYOUTS = (Layout(DEFLATE), Layout(DEFLATE, True), Layout(DEFLATE, tiled=True), Layout(DEFLATE, True, True), Layout(PACKBITS), Layout(LZW, True), Layout(LZW), Layout(PACKBITS, True, True))


def packbits(data: bytes) -> bytes:
    out, at = bytearray(), 0

    def literal(part: bytes) -> None:
        for i in range(0, len(part), 128):
            out.append(len(part[i : i + 128]) - 1)
            out.extend(part[i : i + 128])

    for m in re.finditer(rb"(.)\1{2,127}", data, re.DOTALL):
        literal(data[at : m.start()])
        out += bytes([257 - (m.end() - m.start())]) + m[1]
        at = m.end()
    literal(data[at:])
    return bytes(out)


def unpackbits(data: bytes, most: int) -> bytes:
    out, at, end, size = [], 0, len(data), 0
    while at < end and size < most:
        n = data[at]
        if n < 128:
            out.append(data[at + 1 : at + 2 + n])
            at += n + 2
        else:
            out.append(data[at + 1 : at + 2] * (257 - n) if n > 128 else b"")
            at += 2 if n > 128 else 1
        size += len(out[-1])
    return b"".join(out)


def _widths(free: np.ndarray) -> np.ndarray:
    """Bits of a code that is written when `free` is the next code to be given out."""
    return 9 + (free >= 512) + (free >= 1024) + (free >= 2048)


def lzw(data: bytes) -> bytes:
    """MSB-first codes of 9 to 12 bits, widened one code early, as readers expect."""
    codes, frees, table, free, code = [256], [258], {}, 258, -1
    for byte in data:
        key = code << 8 | byte
        if code < 0:
            code = byte
        elif key in table:
            code = table[key]
        else:
            codes.append(code)
            frees.append(free)
            table[key], code = free, byte
            free += 1
            if free > 4094:
                codes.append(256)
                frees.append(free)
                table, free = {}, 258
    if code >= 0:
        codes.append(code)
        frees.append(free)
        free += 1
    codes, width = np.array([*codes, 257]), _widths(np.array([*frees, free]))
    bits = (codes[:, None] >> np.arange(11, -1, -1)) & 1
    return np.packbits(bits[np.arange(12) >= 12 - width[:, None]].astype(np.uint8)).tobytes()


def unlzw(data: bytes, most: int) -> bytes:
    first = [bytes([i]) for i in range(256)] + [b"", b""]
    raw = np.frombuffer(data + b"\0\0\0", dtype=np.uint8).astype(np.int64)
    words = ((raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]).tolist()
    table, out, size, width, at, last, end = first[:], [], 0, 9, 0, None, 8 * len(data)
    while at + width <= end and size < most:
        code = (words[at >> 3] >> (24 - (at & 7) - width)) & ((1 << width) - 1)
        at += width
        if code == 257:
            break
        if code == 256:
            table, width, last = first[:], 9, None
            continue
        if last is None:
            word = table[code]
        else:
            word = table[code] if code < len(table) else last + last[:1]
            if code > len(table):
                raise ValueError("a code before its entry")
            table.append(last + word[:1])
            if len(table) + 1 >= 1 << width and width < 12:
                width += 1
        out.append(word)
        size += len(word)
        last = word
    return b"".join(out)


def squeeze(data: bytes, compression: int) -> bytes:
    return {NONE: bytes, PACKBITS: packbits, LZW: lzw, DEFLATE: lambda x: zlib.compress(x, 1)}[compression](data)


def expand(data: bytes, compression: int, most: int) -> bytes:
    """The bytes of a strip or tile, no more than `most` or little beyond."""
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.decompressobj().decompress(data, most)
    if compression not in (NONE, PACKBITS, LZW):
        raise ValueError(f"compression {compression} is not read")
    return data[:most] if compression == NONE else {PACKBITS: unpackbits, LZW: unlzw}[compression](data, most)


def _differ(block: np.ndarray) -> np.ndarray:
    out = block.copy()
    out[:, 1:] -= block[:, :-1]
    return out


def encode(payload: bytes, layout: Layout = LAYOUTS[0], width: int = PAGE_WIDTH, page_rows: int = PAGE_ROWS) -> bytes:
    """A TIFF of 8-bit grey pages that hold `payload`, whose size is a multiple of `width`."""
    pixels = np.frombuffer(payload, dtype=np.uint8).reshape(-1, width)
    out, link = bytearray(b"II*\0\0\0\0\0"), 4
    for first in range(0, len(pixels), page_rows):
        page = pixels[first : first + page_rows]
        if layout.tiled:
            grid = np.zeros((-(-len(page) // TILE_SIDE) * TILE_SIDE, -(-width // TILE_SIDE) * TILE_SIDE), dtype=np.uint8)
            grid[: len(page), :width] = page
            blocks = [grid[y : y + TILE_SIDE, x : x + TILE_SIDE] for y in range(0, grid.shape[0], TILE_SIDE) for x in range(0, grid.shape[1], TILE_SIDE)]
        else:
            blocks = [page[y : y + STRIP_ROWS] for y in range(0, len(page), STRIP_ROWS)]
        at, sizes = [], []
        for b in blocks:
            part = squeeze((_differ(b) if layout.predictor else b).tobytes(), layout.compression)
            at.append(len(out))
            sizes.append(len(part))
            out += part + b"\0" * (len(part) % 2)
        tags = {WIDTH: [width], HEIGHT: [len(page)], BITS: [8], COMPRESSION: [layout.compression], PHOTOMETRIC: [1], SAMPLES: [1], PREDICTOR: [2 if layout.predictor else 1]}
        tags |= {TILE_WIDTH: [TILE_SIDE], TILE_HEIGHT: [TILE_SIDE], TILE_AT: at, TILE_BYTES: sizes} if layout.tiled else {STRIP_AT: at, ROWS_PER_STRIP: [STRIP_ROWS], STRIP_BYTES: sizes}
        entries = b""
        for tag, values in sorted(tags.items()):
            body = struct.pack(f"<{len(values)}I", *values)
            if len(values) > 1:
                where = len(out)
                out += body
                body = struct.pack("<I", where)
            entries += struct.pack("<HHI", tag, 4, len(values)) + body
        struct.pack_into("<I", out, link, len(out))
        link = len(out) + 2 + len(entries)
        out += struct.pack("<H", len(tags)) + entries + b"\0\0\0\0"
    return bytes(out)


def directories(data: bytes) -> Iterator[dict[int, list[int]]]:
    """Tags of each image directory, in the order of the chain; a loop in it ends the walk."""
    end = {b"II": "<", b"MM": ">"}[data[:2]]
    magic, at = struct.unpack_from(f"{end}HI", data, 2)
    if magic != 42:
        raise ValueError("not a TIFF")
    seen = set()
    while at and at not in seen:
        seen.add(at)
        (n,) = struct.unpack_from(f"{end}H", data, at)
        tags = {}
        for i in range(n):
            tag, kind, count = struct.unpack_from(f"{end}HHI", data, at + 2 + 12 * i)
            form = {1: "B", 3: "H", 4: "I"}.get(kind)
            if form:
                size = struct.calcsize(f"={count}{form}")
                where = at + 10 + 12 * i if size <= 4 else struct.unpack_from(f"{end}I", data, at + 10 + 12 * i)[0]
                if where + size > len(data):
                    raise ValueError(f"values of tag {tag} are beyond the end")
                tags[tag] = list(struct.unpack_from(f"{end}{count}{form}", data, where))
        yield tags
        (at,) = struct.unpack_from(f"{end}I", data, at + 2 + 12 * n)


def decode_page(data: bytes, tags: dict[int, list[int]]) -> np.ndarray:
    """Rows x columns x samples of a chunky 8-bit page.  Sizes are checked against the data
    before anything is allocated."""
    width, height, samples = tags[WIDTH][0], tags[HEIGHT][0], tags.get(SAMPLES, [1])[0]
    if set(tags.get(BITS, [1])) != {8} or (samples > 1 and tags.get(PLANAR, [1])[0] != 1):
        raise ValueError("only 8-bit samples side by side are read")
    compression, differed = tags.get(COMPRESSION, [1])[0], tags.get(PREDICTOR, [1])[0] == 2
    tiled = TILE_AT in tags
    starts, sizes = (tags[TILE_AT], tags[TILE_BYTES]) if tiled else (tags[STRIP_AT], tags[STRIP_BYTES])
    step_x, step_y = (tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]) if tiled else (width, min(height, tags.get(ROWS_PER_STRIP, [height])[0]))
    if min(width, height, samples, step_x, step_y) < 1:
        raise ValueError("a size of zero")
    across, down = -(-width // step_x), -(-height // step_y)
    if len(starts) != across * down or len(sizes) != len(starts) or max(a + n for a, n in zip(starts, sizes, strict=True)) > len(data):
        raise ValueError("strips or tiles don't fit the page or the data")
    if max(width * height, across * down * step_x * step_y if tiled else 0) * samples > RATIO * (sum(sizes) + 1):
        raise ValueError("the page is larger than its data can be")
    page = np.zeros((height, width, samples), dtype=np.uint8)
    for i, (at, size) in enumerate(zip(starts, sizes, strict=True)):
        y, x = i // across * step_y, i % across * step_x
        rows = step_y if tiled else min(step_y, height - y)
        most = rows * step_x * samples
        raw = expand(data[at : at + size], compression, most)
        block = np.frombuffer(raw[:most], dtype=np.uint8).reshape(rows, step_x, samples)
        if differed:
            block = np.cumsum(block, axis=1, dtype=np.uint8)
        page[y : y + rows, x : x + step_x] = block[: height - y, : width - x]
    return page


PAGE_SCHEMA = "page int, width int, height int, samples int, compression int, predicted boolean, tiled boolean, pixels binary, error string"


def pages(media: DataFrame, column: str = "media") -> DataFrame:
    """A row per page of each TIFF in `column`: all other input columns, then PAGE_SCHEMA.

    Pages of an input row follow each other.  A null value gives one row with page null; a
    broken file gives the pages before the fault and one row with `error`.  Input columns named
    like those of PAGE_SCHEMA are dropped in their favour.  Repeated rows give repeated pages.
    """
    own = [x.split()[0] for x in PAGE_SCHEMA.split(", ")]
    kept = [c for c in media.columns if c != column and c not in own]
    types = [pa.int32()] * 5 + [pa.bool_()] * 2 + [pa.binary(), pa.string()]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(batch: pa.RecordBatch, take: list[int], rows: list[tuple]) -> pa.RecordBatch:
            columns = [batch.column(i).take(pa.array(take, pa.int64())) for i in range(len(kept))]
            return pa.RecordBatch.from_arrays([*columns, *(pa.array([r[j] for r in rows], t) for j, t in enumerate(types))], names=[*kept, *own])

        for batch in batches:
            take, rows, size = [], [], 0
            for i, value in enumerate(batch.column(len(kept))):
                data, page = value.as_py(), 0
                try:
                    for page, tags in enumerate(directories(data)) if data is not None else ():
                        image = decode_page(data, tags)
                        rows.append((page, image.shape[1], image.shape[0], image.shape[2], tags.get(COMPRESSION, [1])[0], tags.get(PREDICTOR, [1])[0] == 2, TILE_AT in tags, image.tobytes(), None))
                        take.append(i)
                        size += image.size
                        if size >= OUT_BYTES:
                            yield flush(batch, take, rows)
                            take, rows, size = [], [], 0
                    fault = None
                except (KeyError, ValueError, IndexError, ArithmeticError, MemoryError, struct.error, zlib.error) as e:
                    fault = f"{type(e).__name__}: {e}"
                if data is None or fault:
                    rows.append((None, None, None, None, None, None, None, None, fault))
                    take.append(i)
            if rows:
                yield flush(batch, take, rows)

    schema = ", ".join(f"`{c}` {media.schema[c].dataType.simpleString()}" for c in kept)
    return media.select(*[F.col(f"`{c}`") for c in kept], F.col(column)).mapInArrow(walk, ", ".join(x for x in (schema, PAGE_SCHEMA) if x))


def store(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """row_id, `key`, n_bytes, payload_bytes, media: each whole text as a TIFF.

    The payload is the UTF-8 text (null: empty) and zero bytes up to a positive multiple of
    64; its layout follows from its own checksum, so equal texts have equal files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, first = [], 0
            for i, value in enumerate(batch.column(2)):
                data = (value.as_py() or "").encode()
                payload = data + b"\0" * (-len(data) % PAGE_WIDTH or (0 if data else PAGE_WIDTH))
                done.append((len(data), len(payload), encode(payload, LAYOUTS[zlib.crc32(payload) % len(LAYOUTS)])))
                if sum(len(d[2]) for d in done[-64:]) > OUT_BYTES or i + 1 == batch.num_rows or len(done) >= 1024:
                    part = batch.slice(first, len(done))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array([d[j] for d in done], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.binary())))], names=["row_id", key, "n_bytes", "payload_bytes", "media"])
                    done, first = [], i + 1

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(key), F.col(text).cast("string").alias("text"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(write, f"row_id long, `{key}` {kind}, n_bytes long, payload_bytes long, media binary")


def digest(page_rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row per stored text from its pages, which follow each other in a task."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, out = None, []

        def close() -> None:
            head, sha, tail, size, hist = open_
            mean = float((hist * np.arange(256)).sum() / size)
            spread = float(np.sqrt(max(0.0, (hist * np.arange(256) ** 2).sum() / size - mean * mean)))
            share = hist[hist > 0] / size
            text = f"mean={mean:.4f};std={spread:.4f};entropy={float(-(share * np.log2(share)).sum()) + 0.0:.4f};levels={len(share)};mode={int(hist.argmax())}"
            out.append((head[1], head[2], size, sha.hexdigest(), zlib.crc32(tail), head[3], head[4], text))

        names = [key, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        types = [kind_arrow[0], pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

        def flush() -> pa.RecordBatch:
            rows = [pa.array([r[j] for r in out], t) for j, t in enumerate(types)]
            out.clear()
            return pa.RecordBatch.from_arrays(rows, names=names)

        for batch in batches:
            kind_arrow[0] = types[0] = batch.column(1).type
            heads = list(zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True))
            for head, value in zip(heads, batch.column(5), strict=True):
                if open_ is None or open_[0][0] != head[0]:
                    if open_ is not None:
                        close()
                    open_ = [head, hashlib.sha256(), b"", 0, np.zeros(256, dtype=np.int64)]
                data = value.as_py() or b""
                open_[1].update(data)
                open_[2] = (open_[2] + data[-64:])[-64:]
                open_[3] += len(data)
                open_[4] += np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
            if out:
                yield flush()
        if open_ is not None:
            close()
            yield flush()

    kind_arrow = [pa.int64()]
    kind = page_rows.schema[key].dataType.simpleString()
    rows = page_rows.select("row_id", key, "n_bytes", "media_bytes", "media_sha256", "pixels")
    return rows.mapInArrow(fold, f"`{key}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def stored_and_read(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Store every text, read every page back, and fold pages into a digest per text."""
    media = store(docs, key, text)
    media = media.withColumn("media_bytes", F.octet_length("media").cast("long")).withColumn("media_sha256", F.sha2("media", 256))
    return digest(pages(media), key)
