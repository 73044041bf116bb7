"""A baseline JPEG encoder in numpy, for sinks on executors without an imaging library.

Colours are not subsampled, all components share one quantisation table, and the Huffman
codes are made for each image. Equal pixels and quality give equal bytes.
"""

from __future__ import annotations

import heapq
import struct

import numpy as np

# The luminance quantisation table of the JPEG standard's annex K, by rows.
LUMINANCE = [
    [16, 11, 10, 16, 24, 40, 51, 61],
    [12, 12, 14, 19, 26, 58, 60, 55],
    [14, 13, 16, 24, 40, 57, 69, 56],
    [14, 17, 22, 29, 51, 87, 80, 62],
    [18, 22, 37, 56, 68, 109, 103, 77],
    [24, 35, 55, 64, 81, 104, 113, 92],
    [49, 64, 78, 87, 103, 121, 120, 101],
    [72, 92, 95, 98, 112, 100, 103, 99],
]

#: Places of a block in zigzag order: by diagonal, every second one upwards.
ZIGZAG = np.array(sorted(range(64), key=lambda p: (p // 8 + p % 8, p // 8 if (p // 8 + p % 8) % 2 else p % 8)))
_K = np.arange(8)
COSINES = np.cos(np.pi * (2 * _K[None, :] + 1) * _K[:, None] / 16) * np.where(_K == 0, np.sqrt(1 / 8), 0.5)[:, None]


def quantisation(quality: int) -> np.ndarray:
    """The table at a quality from 1 to 100, scaled as the usual libraries do."""
    scale = 5000 // quality if quality < 50 else 200 - 2 * quality
    return np.clip((np.array(LUMINANCE) * scale + 50) // 100, 1, 255)


def code_lengths(counts: np.ndarray) -> dict[int, int]:
    """Bits of each symbol that occurs, 16 at most, leaving the code of ones alone free."""
    counts = counts.astype(np.int64)
    while True:
        # the symbol -1 never occurs, so it is among the longest and takes the code of ones
        heap = [(0, -1, [-1]), *((int(counts[s]), int(s), [int(s)]) for s in np.flatnonzero(counts))]
        heapq.heapify(heap)
        length = {s: 0 for _, s, _ in heap}
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for s in a[2] + b[2]:
                length[s] += 1
            heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
        if max(length.values()) <= 16:
            length.pop(-1)
            return length
        counts = np.where(counts > 0, np.maximum(counts // 2, 1), 0)


def _table(kind: int, counts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(segment, code of each symbol, bits of each symbol)."""
    length = code_lengths(counts)
    order = sorted(length, key=lambda s: (length[s], s))
    codes, bits, code, last = np.zeros(256, np.int64), np.zeros(256, np.int64), 0, 0
    for s in order:
        code <<= length[s] - last
        last = length[s]
        codes[s], bits[s] = code, last
        code += 1
    sizes = bytes(sum(n == i for n in length.values()) for i in range(1, 17))
    return _segment(0xC4, bytes([kind]) + sizes + bytes(order)), codes, bits


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _coefficients(a: np.ndarray, table: np.ndarray) -> np.ndarray:
    """(blocks, 3, 64) quantised, in zigzag order."""
    h, w, _ = a.shape
    a = np.pad(a, ((0, -h % 8), (0, -w % 8), (0, 0)), "edge").astype(np.float64)
    r, g, b = a[..., 0], a[..., 1], a[..., 2]
    y = 0.299 * r + 0.587 * g + 0.114 * b
    planes = np.stack([y - 128, (b - y) / 1.772, (r - y) / 1.402])
    cells = planes.reshape(3, a.shape[0] // 8, 8, a.shape[1] // 8, 8).transpose(1, 3, 0, 2, 4)
    found = np.rint(COSINES @ cells @ COSINES.T / table).astype(np.int64)
    return found.reshape(-1, 3, 64)[:, :, ZIGZAG]


def _bits(values: np.ndarray, lengths: np.ndarray) -> bytes:
    """The values' lowest bits one after the other, filled up with ones."""
    ends = np.cumsum(lengths)
    total = int(ends[-1])
    shift = np.repeat(ends, lengths) - 1 - np.arange(total)
    out = ((np.repeat(values, lengths) >> shift) & 1).astype(np.uint8)
    return np.packbits(np.r_[out, np.ones(-total % 8, np.uint8)]).tobytes()


def encode(a: np.ndarray, quality: int = 94) -> bytes:
    """A JPEG file of (height, width, 3) bytes of red, green and blue."""
    h, w, _ = a.shape
    if not 0 < h < 1 << 16 or not 0 < w < 1 << 16:
        raise ValueError(f"an image of {w} x {h} pixels")
    table = quantisation(quality)
    found = _coefficients(a, table)
    found[1:, :, 0], first = np.diff(found[:, :, 0], axis=0), found[0, :, 0].copy()
    found[0, :, 0] = first
    flat = found.reshape(-1, 64)
    row, col = np.nonzero(flat[:, 1:])
    col += 1
    before = np.where(np.r_[True, row[1:] != row[:-1]], 0, np.r_[0, col[:-1]]) if len(row) else col
    run = col - before - 1
    zrl = np.repeat(np.arange(len(row)), run // 16)
    nth = np.arange(len(zrl)) - np.repeat(np.cumsum(run // 16) - run // 16, run // 16)
    end = np.flatnonzero(flat[:, 63] == 0)
    blocks = np.arange(len(flat))
    # a place in the stream: block, column, and 16 zeros before the value itself
    place = np.concatenate([blocks * 260 + 3, row * 260 + col * 4 + 3, row[zrl] * 260 + col[zrl] * 4 + nth, end * 260 + 256])
    value = np.concatenate([flat[:, 0], flat[row, col], np.zeros(len(zrl) + len(end), np.int64)])
    size = np.ceil(np.log2(np.abs(value) + 1)).astype(np.int64)
    symbol = size + 16 * np.concatenate([np.zeros(len(flat), np.int64), run % 16, np.full(len(zrl), 15), np.zeros(len(end), np.int64)])
    dc = np.arange(len(place)) < len(flat)
    dc_segment, dc_codes, dc_bits = _table(0x00, np.bincount(symbol[dc], minlength=256))
    ac_segment, ac_codes, ac_bits = _table(0x10, np.bincount(symbol[~dc], minlength=256))
    extra = np.where(value < 0, value + (1 << size) - 1, value)
    code = (np.where(dc, dc_codes[symbol], ac_codes[symbol]) << size) | extra
    order = np.argsort(place)
    data = _bits(code[order], (np.where(dc, dc_bits[symbol], ac_bits[symbol]) + size)[order]).replace(b"\xff", b"\xff\0")
    parts = [
        b"\xff\xd8", _segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0"), _segment(0xDB, b"\0" + bytes(table.ravel()[ZIGZAG].astype(np.uint8))),
        _segment(0xC0, struct.pack(">BHHB", 8, h, w, 3) + bytes([1, 0x11, 0, 2, 0x11, 0, 3, 0x11, 0])), dc_segment, ac_segment,
        _segment(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0])), data, b"\xff\xd9",
    ]
    return b"".join(parts)
