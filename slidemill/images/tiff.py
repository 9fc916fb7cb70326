"""TIFF in numpy: 8-bit grey or RGB in strips, uncompressed, deflated or LZW-packed, also as differences to the left."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, OFFSETS, SAMPLES, ROWS, COUNTS, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 317
# Codes of LZW that clear the table and end the data, and its widest code in bits.
CLEAR, END, WIDEST = 256, 257, 12


def decode(data: bytes) -> np.ndarray:
    """The pixels as height x width (x 3) uint8; ValueError if they cannot be read completely."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
    if order is None:
        raise ValueError("no TIFF")
    try:
        tags = _tags(data, order)
        height, width = tags[HEIGHT][0], tags[WIDTH][0]
        samples = tags.get(SAMPLES, (1,))[0]
        if set(tags.get(BITS, (8,))) != {8} or samples not in (1, 3):
            raise ValueError("only 8-bit grey or RGB")
        packing = tags.get(COMPRESSION, (1,))[0]
        strips = [data[a : a + n] for a, n in zip(tags[OFFSETS], tags[COUNTS])]
        if packing in (8, 32946):
            strips = [zlib.decompress(s) for s in strips]
        elif packing == 5:
            strips = [unpack_lzw(s) for s in strips]
        elif packing != 1:
            raise ValueError(f"compression {packing} is not supported")
        pixels = np.frombuffer(b"".join(strips), np.uint8)
        if len(pixels) < height * width * samples:
            raise ValueError("truncated")
        pixels = pixels[: height * width * samples].reshape((height, width, samples) if samples > 1 else (height, width))
        if tags.get(PREDICTOR, (1,))[0] == 2:
            pixels = np.cumsum(pixels, axis=1, dtype=np.uint8)
        return 255 - pixels if samples == 1 and tags.get(PHOTOMETRIC, (1,))[0] == 0 else pixels
    except (struct.error, KeyError, zlib.error, IndexError) as e:
        raise ValueError(f"damaged TIFF: {e}") from e


def unpack_lzw(data: bytes) -> bytes:
    """The bytes of an LZW strip: codes of 9 to 12 bits, highest bit first, widened one code early."""
    out, table = bytearray(), []
    bits = held = 0
    width, before = 9, b""
    for byte in data:
        held, bits = (held << 8 | byte) & 0xFFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & ((1 << width) - 1)
        if code == END:
            break
        if code == CLEAR:
            table, width, before = [], 9, b""
            continue
        if code < CLEAR:
            now = bytes([code])
        elif code - END - 1 < len(table):
            now = table[code - END - 1]
        elif before and code - END - 1 == len(table):
            now = before + before[:1]
        else:
            raise ValueError("damaged TIFF: unknown LZW code")
        out += now
        if before and len(table) < (1 << WIDEST) - END - 1:
            table.append(before + now[:1])
        before = now
        while width < WIDEST and len(table) + END + 2 >= 1 << width:
            width += 1
    return bytes(out)


def _tags(data: bytes, order: str) -> dict[int, tuple[int, ...]]:
    (at,) = struct.unpack_from(f"{order}I", data, 4)
    (n,) = struct.unpack_from(f"{order}H", data, at)
    out = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * k)
        if kind not in (1, 3, 4):
            continue
        place = at + 2 + 12 * k + 8
        if count * _SIZES[kind] > 4:
            (place,) = struct.unpack_from(f"{order}I", data, place)
        out[tag] = struct.unpack_from(f"{order}{count}{ {1: 'B', 3: 'H', 4: 'I'}[kind] }", data, place)
    return out


def encode(pixels: np.ndarray, deflate: bool = False) -> bytes:
    """A little-endian TIFF of one strip."""
    height, width = pixels.shape[:2]
    samples = pixels.shape[2] if pixels.ndim == 3 else 1
    body = np.ascontiguousarray(pixels, np.uint8).tobytes()
    body = zlib.compress(body) if deflate else body
    start = 8
    bits_at = start + len(body) + len(body) % 2
    entries = [
        (WIDTH, 4, 1, width), (HEIGHT, 4, 1, height), (BITS, 3, samples, bits_at if samples > 2 else 8), (COMPRESSION, 3, 1, 8 if deflate else 1),
        (PHOTOMETRIC, 3, 1, 2 if samples == 3 else 1), (OFFSETS, 4, 1, start), (SAMPLES, 3, 1, samples), (ROWS, 4, 1, height), (COUNTS, 4, 1, len(body)),
    ]
    directory = bits_at + 2 * samples
    out = bytearray(b"II*\0" + struct.pack("<I", directory) + body + b"\0" * (len(body) % 2) + struct.pack(f"<{samples}H", *[8] * samples))
    out += struct.pack("<H", len(entries))
    for tag, kind, count, value in entries:
        out += struct.pack("<HHI", tag, kind, count) + (struct.pack("<HH", value, 0) if kind == 3 and count == 1 else struct.pack("<I", value))
    return bytes(out + struct.pack("<I", 0))


def describe(data: bytes) -> tuple[bool, str]:
    """Whether the image decodes completely, and its size and mode or what is wrong."""
    try:
        pixels = decode(data)
    except ValueError as e:
        return False, str(e)
    return True, f"{pixels.shape[1]}x{pixels.shape[0]} {'RGB' if pixels.ndim == 3 else 'L'}"
