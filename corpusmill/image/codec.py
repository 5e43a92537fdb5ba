"""Image headers of common formats and pixels of PNG and BMP, in numpy; other formats need PIL, if it is installed."""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np

_PNG = b"\x89PNG\r\n\x1a\n"


def header(data: bytes | None) -> tuple[int, int, str] | None:
    """(width, height, format) by the header alone, None if no format is known by it."""
    if not data or len(data) < 10:
        return None
    if data[:8] == _PNG and data[12:16] == b"IHDR":
        return (*struct.unpack(">II", data[16:24]), "PNG")
    if data[:6] in (b"GIF87a", b"GIF89a"):
        return (*struct.unpack("<HH", data[6:10]), "GIF")
    if data[:2] == b"BM" and len(data) >= 26:
        w, h = struct.unpack("<ii", data[18:26])
        return w, abs(h), "BMP"
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP" and len(data) >= 30:
        return _webp(data)
    if data[:2] == b"\xff\xd8":
        return _jpeg(data)
    return None


def _webp(data: bytes):
    kind = data[12:16]
    if kind == b"VP8X":
        return 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little"), "WEBP"
    if kind == b"VP8L":
        bits = int.from_bytes(data[21:25], "little")
        return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF), "WEBP"
    w, h = struct.unpack("<HH", data[26:30])
    return w & 0x3FFF, h & 0x3FFF, "WEBP"


def _jpeg(data: bytes):
    at = 2
    while at + 9 < len(data):
        if data[at] != 0xFF:
            at += 1
            continue
        marker = data[at + 1]
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            h, w = struct.unpack(">HH", data[at + 5 : at + 9])
            return w, h, "JPEG"
        if marker in (0xFF, 0x01) or 0xD0 <= marker <= 0xD9:
            at += 1 if marker == 0xFF else 2
            continue
        at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


def decode(data: bytes | None) -> tuple[np.ndarray, str] | None:
    """(pixels [height, width, 3] uint8, format), None if the bytes can't be decoded."""
    if not data:
        return None
    try:
        if data[:8] == _PNG:
            return _png(data), "PNG"
        if data[:2] == b"BM":
            return _bmp(data), "BMP"
        from PIL import Image

        with Image.open(io.BytesIO(data)) as image:
            return np.asarray(image.convert("RGB")), image.format or "UNKNOWN"
    except Exception:  # decoders raise many kinds for broken bytes
        return None


def _bmp(data: bytes) -> np.ndarray:
    offset, (w, h), bits = int.from_bytes(data[10:14], "little"), struct.unpack("<ii", data[18:26]), int.from_bytes(data[28:30], "little")
    if bits not in (24, 32) or int.from_bytes(data[30:34], "little") not in (0, 3):
        raise ValueError("only plain 24 and 32 bit BMP")
    stride = (w * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(h), offset).reshape(abs(h), stride)[:, : w * bits // 8]
    pixels = rows.reshape(abs(h), w, bits // 8)[..., 2::-1]
    return pixels[::-1] if h > 0 else pixels


def _png(data: bytes) -> np.ndarray:
    at, parts, palette = 8, [], None
    width = height = depth = colour = interlace = 0
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            width, height, depth, colour, _, _, interlace = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            parts.append(body)
        elif kind == b"IEND":
            break
        at += 12 + size
    if depth != 8 or interlace or colour not in (0, 2, 3, 4, 6):
        raise ValueError("only 8-bit PNG without interlace")
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    raw = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height, width * channels), np.uint8)
    above = np.zeros(width * channels, np.uint8)
    for y in range(height):
        above = out[y] = _unfilter(int(raw[y, 0]), raw[y, 1:], above, channels)
    pixels = out.reshape(height, width, channels)
    if colour == 3:
        return palette[pixels[..., 0]]
    return np.repeat(pixels[..., :1], 3, axis=2) if colour in (0, 4) else pixels[..., :3]


def _unfilter(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 1:
        return np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
    if kind == 2:
        return line + above
    out = bytearray(line.tobytes())
    up = above.tobytes()
    for i in range(len(out)):
        a = out[i - step] if i >= step else 0
        if kind == 3:
            guess = (a + up[i]) // 2
        else:
            c = up[i - step] if i >= step else 0
            p = a + up[i] - c
            guess = min((abs(p - a), 0, a), (abs(p - up[i]), 1, up[i]), (abs(p - c), 2, c))[2]
        out[i] = (out[i] + guess) & 0xFF
    return np.frombuffer(bytes(out), np.uint8)


def encode_png(pixels: np.ndarray) -> bytes:
    """An 8-bit PNG of [height, width] gray or [height, width, 3] colour pixels."""
    height, width = pixels.shape[:2]
    colour = 0 if pixels.ndim == 2 else 2
    lines = np.concatenate((np.zeros((height, 1), np.uint8), np.ascontiguousarray(pixels, np.uint8).reshape(height, -1)), axis=1)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return _PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")
