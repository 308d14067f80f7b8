"""PNG images as arrays, without an imaging library: 8 bits a channel, not interlaced.

Images are arrays of height, width and 3 channels.  Transparency is laid on white.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

_SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Channels of a colour type.
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _parts(png: bytes):
    if png[:8] != _SIGNATURE:
        raise ValueError("not a PNG image")
    at = 8
    while at < len(png):
        (n,) = struct.unpack(">I", png[at : at + 4])
        yield png[at + 4 : at + 8], png[at + 8 : at + 8 + n]
        at += n + 12


def _unfilter(rows: np.ndarray, width: int, channels: int) -> np.ndarray:
    """Undo the five line filters; each line leads with the number of its own."""
    out = np.zeros((len(rows), width * channels), np.uint8)
    up = np.zeros(width * channels, np.int64)
    for y, line in enumerate(rows):
        kind, now = line[0], line[1:].astype(np.int64)
        if kind == 2:
            now = (now + up) & 255
        elif kind == 1:
            now = np.cumsum(now.reshape(width, channels), axis=0).reshape(-1) & 255
        elif kind in (3, 4):
            for x in range(len(now)):
                left = now[x - channels] if x >= channels else 0
                if kind == 3:
                    near = (left + up[x]) // 2
                else:
                    corner = up[x - channels] if x >= channels else 0
                    guess = left + up[x] - corner
                    near = min((abs(guess - c), i, c) for i, c in enumerate((left, up[x], corner)))[2]
                now[x] = (now[x] + near) & 255
        elif kind:
            raise ValueError(f"no such line filter: {kind}")
        out[y], up = now, now
    return out


def decode(png: bytes) -> np.ndarray:
    data, palette, clear, head = b"", None, None, None
    for name, body in _parts(png):
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif name == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif name == b"tRNS":
            clear = body
        elif name == b"IDAT":
            data += body
    if head is None:
        raise ValueError("a PNG image without a header")
    width, height, depth, colour, _, _, interlaced = head
    if depth != 8 or interlaced or colour not in _CHANNELS:
        raise ValueError("only 8 bits a channel, not interlaced")
    channels = _CHANNELS[colour]
    rows = np.frombuffer(zlib.decompress(data), np.uint8).reshape(height, 1 + width * channels)
    px = _unfilter(rows, width, channels).reshape(height, width, channels)
    if colour == 3:
        alpha = np.full(256, 255, np.uint8)
        if clear:
            alpha[: len(clear)] = np.frombuffer(clear, np.uint8)
        px = np.concatenate([palette[px[..., 0]], alpha[px]], axis=2)
    if px.shape[2] in (2, 4):  # on white
        a = px[..., -1:].astype(np.float64) / 255
        px = np.rint(px[..., :-1] * a + 255 * (1 - a)).astype(np.uint8)
    return np.repeat(px, 3, axis=2) if px.shape[2] == 1 else px


def encode(pixels: np.ndarray) -> bytes:
    height, width, _ = pixels.shape
    lines = np.concatenate([np.zeros((height, 1), np.uint8), pixels.astype(np.uint8).reshape(height, -1)], axis=1)
    part = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return _SIGNATURE + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines.tobytes(), 6)) + part(b"IEND", b"")


def crop(pixels: np.ndarray, rect: tuple[float, float, float, float], scale: float = 1.0) -> np.ndarray:
    """The part in (x0, y0, x1, y1) from the top left, in units of ``scale`` pixels."""
    height, width, _ = pixels.shape
    x0, y0, x1, y1 = (int(round(v * scale)) for v in rect)
    x0, x1, y0, y1 = max(0, x0), min(width, x1), max(0, y0), min(height, y1)
    if x1 <= x0 or y1 <= y0:
        raise ValueError("an empty crop")
    return pixels[y0:y1, x0:x1]


def stitch(first: np.ndarray, second: np.ndarray, orientation: str) -> np.ndarray:
    """Both images on one white canvas, side by side or one below the other."""
    (h1, w1, _), (h2, w2, _) = first.shape, second.shape
    flat = orientation == "horizontal"
    if not flat and orientation != "vertical":
        raise ValueError(f"no such orientation: {orientation}")
    out = np.full((max(h1, h2), w1 + w2, 3) if flat else (h1 + h2, max(w1, w2), 3), 255, np.uint8)
    out[:h1, :w1] = first
    if flat:
        out[:h2, w1:] = second
    else:
        out[h1:, :w2] = second
    return out


def outline(pixels: np.ndarray, rect: tuple[float, float, float, float], scale: float = 1.0, colour: tuple[int, int, int] = (255, 0, 0), line: int = 2) -> np.ndarray:
    """A copy with the frame of a rectangle drawn."""
    height, width, _ = pixels.shape
    x0, y0, x1, y1 = (int(round(v * scale)) for v in rect)
    x0, x1, y0, y1 = max(0, x0), min(width, x1), max(0, y0), min(height, y1)
    out = pixels.copy()
    inside = out[y0:y1, x0:x1]
    kept = inside[line:-line, line:-line].copy()
    inside[:] = colour
    inside[line:-line, line:-line] = kept
    return out
