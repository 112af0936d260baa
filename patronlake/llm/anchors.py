"""Content-chosen suffix positions of byte texts: the sampled positions of a sparse suffix array.

Of every window of `SPAN` bytes the 16-byte string with the least hash is the window's anchor. Which one
that is depends on the window's bytes alone, so equal windows of two documents have equal anchors.
Neighbouring windows mostly share their anchor; all windows of one anchor form a *segment*, the bytes
from the first window's start to the last one's end. A suffix array over anchors (about one byte in
eighteen) therefore finds every repeat of `SPAN` bytes, which one over a fixed stride would not.

Everything here is Numpy over the bytes of one batch of documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPAN = 50
ANCHOR = 16
REACH = SPAN - ANCHOR + 1  # anchors to choose from in a window, and windows of a segment at most
_POS_BITS = 27  # positions inside a batch; `scan` cuts larger ones
_MAX_BATCH = 1 << _POS_BITS

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xC2B2AE3D27D4EB4F)
_M3 = np.uint64(0xFF51AFD7ED558CCD)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_UNBASE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _M3
    x ^= x >> np.uint64(29)
    x *= _M1
    x ^= x >> np.uint64(32)
    return x


def _eights(buffer: bytes, n: int) -> np.ndarray:
    """The 8 bytes from each of the first n positions as a number; buffer has 8 bytes to spare."""
    return np.ndarray((n,), "<u8", buffer, 0, (1,)).copy()


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Sliding minimum, in a logarithmic number of passes."""
    m, have = h, 1
    while have * 2 <= width:
        m, have = np.minimum(m[:-have], m[have:]), have * 2
    return np.minimum(m[: len(m) - (width - have)], m[width - have :]) if have < width else m


@dataclass
class Segments:
    """Columns by segment. `doc` is the index in the batch; `start` to `end` its bytes in `buffer`."""

    buffer: bytes
    doc: np.ndarray
    anchor: np.ndarray
    start: np.ndarray
    end: np.ndarray
    prefix: np.ndarray  # first 8 bytes of the suffix at the anchor, ordered as signed numbers
    group: np.ndarray  # 32-bit hash of the suffix's next 8 bytes
    body: np.ndarray  # 64-bit hash of the whole segment
    start_in_text: np.ndarray | None = None


def segments(texts: list[bytes]) -> Segments:
    """All segments of all texts, in order. Texts below SPAN bytes have none; none crosses texts."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    if total >= _MAX_BATCH:
        raise ValueError("batch too large; use scan")
    buffer = b"".join(texts) + bytes(16)
    windows = total - SPAN + 1
    if windows <= 0:
        none = np.empty(0, np.int64)
        return Segments(buffer, none, none, none, none, none, none.astype(np.int32), none)
    eight = _eights(buffer, total + 8)
    h = eight[:-8] * _M1 ^ (eight[8:] + _M2) * _M2
    h = _mixed(h[: total - ANCHOR + 1])
    h &= ~np.uint64(_MAX_BATCH - 1)
    h |= np.arange(len(h), dtype=np.uint64)  # equal hashes: the leftmost
    at = (_least(h, REACH) & np.uint64(_MAX_BATCH - 1)).astype(np.int64)
    # windows that cross into the next text are no windows
    inside = np.ones(windows, bool)
    for back in range(1, SPAN):
        cut = ends[:-1] - back
        inside[cut[(cut >= 0) & (cut < windows)]] = False
    new = np.empty(windows, bool)
    new[0] = True
    np.not_equal(at[1:], at[:-1], out=new[1:])
    new[1:] |= ~inside[:-1]
    new &= inside
    first = np.flatnonzero(new)
    last_flag = np.empty(windows, bool)
    last_flag[-1] = inside[-1]
    last_flag[:-1] = inside[:-1] & (new[1:] | ~inside[1:])
    last = np.flatnonzero(last_flag)
    start, end, anchor = first, last + SPAN, at[first]
    # a segment's hash: its 8-byte strings, mixed, as a polynomial
    power = np.empty(total + 1, np.uint64)
    power[0] = 1
    power[1:] = _BASE
    np.multiply.accumulate(power, out=power)
    terms = _mixed(eight[:total]) * power[:total]
    prefix_sum = np.empty(total + 1, np.uint64)
    prefix_sum[0] = 0
    np.cumsum(terms, out=prefix_sum[1:])
    inverse = np.empty(total + 1, np.uint64)
    inverse[0] = 1
    inverse[1:] = _UNBASE
    np.multiply.accumulate(inverse, out=inverse)
    # the last 8-byte string of a segment starts 8 bytes before its end
    body = (prefix_sum[end - 7] - prefix_sum[start]) * inverse[start]
    body = _mixed(body + (end - start).astype(np.uint64) * _M2)
    big = eight[anchor].byteswap()
    return Segments(
        buffer,
        np.searchsorted(ends, start, side="right"),
        anchor,
        start,
        end,
        (big ^ np.uint64(1 << 63)).view(np.int64),
        (_mixed(eight[anchor + 8]) >> np.uint64(32)).astype(np.uint32).view(np.int32),
        body.view(np.int64),
    )


def scan(texts: list[bytes], most: int = 1 << 18):
    """Segments of all texts in batches of about `most` bytes, with `doc` the index in `texts` and
    `start_in_text` beside it.

    A longer text is scanned in pieces that overlap by SPAN - 1 bytes, so each window is in exactly one
    piece; segments are cut where pieces meet.
    """
    pieces, held = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - SPAN + 1), most):
            piece = text if len(text) <= most else text[at : at + most + SPAN - 1]
            if pieces and held + len(piece) > most + SPAN:
                yield _scanned(pieces)
                pieces, held = [], 0
            pieces.append((i, at, piece))
            held += len(piece)
            if piece is text:
                break
    if pieces:
        yield _scanned(pieces)


def _scanned(pieces) -> Segments:
    s = segments([piece for _, _, piece in pieces])
    lengths = np.fromiter((len(piece) for _, _, piece in pieces), np.int64, len(pieces))
    shift = np.fromiter((at for _, at, _ in pieces), np.int64, len(pieces)) - (np.cumsum(lengths) - lengths)
    s.start_in_text = s.start + shift[s.doc]
    s.doc = np.fromiter((i for i, _, _ in pieces), np.int64, len(pieces))[s.doc]
    return s
