"""PNG of 8-bit grey or RGB in numpy: written unfiltered, read with all five row filters."""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode(pixels: np.ndarray) -> bytes:
    """Height x width (x 3) uint8 as PNG."""
    height, width = pixels.shape[:2]
    rows = np.ascontiguousarray(pixels, np.uint8).reshape(height, -1)
    raw = np.concatenate([np.zeros((height, 1), np.uint8), rows], axis=1).tobytes()
    head = struct.pack(">IIBBBBB", width, height, 8, 2 if pixels.ndim == 3 else 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw, 9)) + _chunk(b"IEND", b"")


def decode(data: bytes) -> np.ndarray:
    """The pixels, without an alpha channel; ValueError for other kinds of PNG and damaged files."""
    if data[:8] != SIGNATURE:
        raise ValueError("no PNG")
    at, body, head = 8, [], None
    try:
        while at < len(data):
            (size,) = struct.unpack_from(">I", data, at)
            kind, part = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
            if kind == b"IHDR":
                head = struct.unpack(">IIBBBBB", part)
            elif kind == b"IDAT":
                body.append(part)
            elif kind == b"IEND":
                break
            at += size + 12
        if head is None or head[2] != 8 or head[3] not in _CHANNELS or head[6]:
            raise ValueError("only 8-bit grey or RGB without interlace")
        raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8)
    except (struct.error, zlib.error) as e:
        raise ValueError(f"damaged PNG: {e}") from e
    width, height, channels = head[0], head[1], _CHANNELS[head[3]]
    if len(raw) != height * (width * channels + 1):
        raise ValueError("truncated")
    lines = raw.reshape(height, -1)
    out = np.zeros((height, width * channels), np.uint8)
    above = np.zeros(width * channels, np.uint8)
    for y in range(height):
        out[y] = above = _unfilter(int(lines[y, 0]), lines[y, 1:], above, channels)
    pixels = out.reshape(height, width, channels)
    colour = pixels[:, :, : channels - 1] if channels in (2, 4) else pixels
    return colour[:, :, 0] if colour.shape[2] == 1 else colour


def _unfilter(kind: int, line: np.ndarray, above: np.ndarray, channels: int) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 1:
        return np.cumsum(line.reshape(-1, channels), axis=0, dtype=np.uint8).ravel()
    if kind == 2:
        return line + above
    if kind not in (3, 4):
        raise ValueError(f"filter {kind}")
    out = np.zeros(len(line), np.uint8)
    for i in range(len(line)):
        left = int(out[i - channels]) if i >= channels else 0
        up = int(above[i])
        if kind == 3:
            guess = (left + up) // 2
        else:
            corner = int(above[i - channels]) if i >= channels else 0
            guess = min((left, up, corner), key=lambda v: abs(left + up - corner - v))
        out[i] = (int(line[i]) + guess) & 255
    return out
