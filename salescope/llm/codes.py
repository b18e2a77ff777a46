"""Arrays of character codes: normalising texts, polynomial hashes of n-grams
and look-ups in sorted hash arrays, on whole batches at a time."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np

from salescope.llm.common import ship

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SPACE = 32
#: Characters handled at a time; longer texts are folded piece by piece.
PIECE = 1 << 18


def char_table(digits: bool) -> np.ndarray:
    """Code point -> lower-cased letter (and digit, if wanted), else a space."""
    table = np.full(sys.maxunicode + 1, SPACE, np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha() or digits and c.isdigit():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def pieces(texts: list[str], size: int = PIECE) -> Iterator[tuple[list[int], list[str], bool]]:
    """Batches of whole texts, ``size`` characters or less together, as
    (indices, texts, False); of a longer text each piece as ([i], [piece],
    True when it goes on from the piece before)."""
    idx: list[int] = []
    part: list[str] = []
    total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield idx, part, False
            idx, part, total = [], [], 0
        if len(t) > size:
            for at in range(0, len(t), size):
                yield [i], [t[at:at + size]], at > 0
            continue
        idx.append(i)
        part.append(t)
        total += len(t)
    if idx:
        yield idx, part, False


def normalise(parts: list[str], table: np.ndarray, after_space: bool = True):
    """Codes of all parts without the spaces at their start and with runs of
    spaces made one: (codes, kept raw index, lengths of the parts)."""
    raw = table[codes_of("".join(parts))]
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
    space = raw == SPACE
    before = np.empty_like(space)
    before[1:] = space[:-1]
    starts = np.concatenate([[0], ends[:-1]])
    starts = starts[starts < len(raw)]
    before[starts] = after_space
    kept = np.flatnonzero(~(space & before))
    upto = np.searchsorted(kept, ends)
    return raw[kept], kept, np.diff(upto, prepend=0)


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """``out[k - 1][i]``: hash of the k codes that end at i (codes before the
    start count as 0)."""
    c = codes.astype(np.uint64) + np.uint64(1)
    out = [c]
    power = BASE
    for k in range(1, order):
        h = out[-1].copy()
        h[k:] += c[:-k] * power
        out.append(h)
        power = np.uint64(int(power) * int(BASE) & 0xFFFFFFFFFFFFFFFF)
    return out


def gram_hash(codes: np.ndarray, order: int) -> np.ndarray:
    """The last of ``gram_hashes`` alone."""
    c = codes.astype(np.uint64) + np.uint64(1)
    out = c.copy()
    power = BASE
    for k in range(1, order):
        out[k:] += c[:-k] * power
        power = np.uint64(int(power) * int(BASE) & 0xFFFFFFFFFFFFFFFF)
    return out


def hash_rows(rows: np.ndarray) -> np.ndarray:
    """The same hash of each row of codes (oldest first)."""
    h = np.zeros(len(rows), np.uint64)
    for j in range(rows.shape[1]):
        h = h * BASE + rows[:, j].astype(np.uint64) + np.uint64(1)
    return h


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in the sorted ``keys`` and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


ship(__name__)
