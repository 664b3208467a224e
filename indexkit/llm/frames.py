"""Seekable compressed text: independent zstandard frames with cumulative counts.

A text is cut every ``FRAME_CHARS`` characters; each piece is one zstandard
frame that can be read alone.  Beside the frames stand two running counts, the
characters and the line ends up to the end of each frame, so the frame that
holds a given line end or character is found by binary search and only that
frame is decompressed.  Whole frames move from one text to another as they
are; only frames in which a cut falls are compressed anew.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import zstandard

FRAME_CHARS = 1 << 16
_LEVEL = 1


class Frames:
    """One text as frames.  ``chars`` and ``ends`` are running counts of
    characters and line ends; each has as many entries as there are frames."""

    __slots__ = ("data", "chars", "ends")

    def __init__(self, data: list[bytes] | None = None, chars: list[int] | None = None, ends: list[int] | None = None):
        self.data = data or []
        self.chars = chars or []
        self.ends = ends or []

    @classmethod
    def of(cls, text: str, frame_chars: int = FRAME_CHARS) -> Frames:
        out = cls()
        pack = zstandard.ZstdCompressor(level=_LEVEL).compress
        for at in range(0, len(text), frame_chars):
            piece = text[at:at + frame_chars]
            out.add(pack(piece.encode("utf-8")), len(piece), piece.count("\n"))
        return out

    def add(self, frame: bytes, chars: int, ends: int) -> None:
        self.data.append(frame)
        self.chars.append(self.n_chars + chars)
        self.ends.append(self.n_ends + ends)

    @property
    def n_chars(self) -> int:
        return self.chars[-1] if self.chars else 0

    @property
    def n_ends(self) -> int:
        return self.ends[-1] if self.ends else 0

    def piece(self, k: int) -> str:
        return zstandard.ZstdDecompressor().decompress(self.data[k]).decode("utf-8")

    def stream(self) -> Iterator[bytes]:
        """The text's UTF-8 bytes, one frame at a time, in order."""
        unpack = zstandard.ZstdDecompressor().decompress
        for frame in self.data:
            yield unpack(frame)

    def after_units(self, units: int) -> int:
        """Characters before the end of line number ``units`` (from 1; 0 gives
        0); the end of the text when it has fewer line ends."""
        if units <= 0:
            return 0
        if units > self.n_ends:
            return self.n_chars
        k = bisect_left(self.ends, units)
        piece, at = self.piece(k), -1
        for _ in range(units - (self.ends[k - 1] if k else 0)):
            at = piece.index("\n", at + 1)
        return (self.chars[k - 1] if k else 0) + at + 1

    def append(self, other: Frames, lo: int = 0, hi: int | None = None) -> Frames:
        """Add characters ``lo`` to ``hi`` of another text."""
        hi = other.n_chars if hi is None else hi
        if lo >= hi:
            return self
        pack = None
        k = bisect_right(other.chars, lo)
        while k < len(other.data) and (start := other.chars[k - 1] if k else 0) < hi:
            stop = other.chars[k]
            if lo <= start and stop <= hi:
                self.add(other.data[k], stop - start, other.ends[k] - (other.ends[k - 1] if k else 0))
            else:
                part = other.piece(k)[max(lo - start, 0):hi - start]
                pack = pack or zstandard.ZstdCompressor(level=_LEVEL).compress
                self.add(pack(part.encode("utf-8")), len(part), part.count("\n"))
            k += 1
        return self

    def find(self, marks: list[str]) -> list[int]:
        """Character positions of ``marks``, each searched after the one before
        it, in one pass over the frames; a missing mark raises ValueError."""
        found: list[int] = []
        held, base = "", 0
        longest = max(map(len, marks), default=1)
        for k in range(len(self.data)):
            held += self.piece(k)
            at = 0
            while len(found) < len(marks) and (p := held.find(marks[len(found)], at)) >= 0:
                found.append(base + p)
                at = p + len(marks[len(found) - 1])
            if len(found) == len(marks):
                return found
            at = max(at, len(held) - longest + 1)
            held, base = held[at:], base + at
        if len(found) < len(marks):
            raise ValueError(f"mark {marks[len(found)]!r} not found")
        return found
