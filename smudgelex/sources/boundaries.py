"""Where documents begin and end in the bytes of an SGML file.

A document begins at the start of the file, behind a real end tag, and at a real start
tag whose document has a number of its own. A start tag without one is part of the
document around it. A tag is real unless a comment or another tag swallows it, and both
end at the next ``>``; so behind any ``>`` nothing that came before matters, and a
reader that starts in the middle of a file finds the same places as one that read all.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

# A comment, a tag that is cut off by another one, and the tags that matter here.
# All begin with the same byte, which the search then skips to.
_EVENT = re.compile(rb"<(?:![^>]*>|[^\s<>!][^\s<>]{0,255}<[^\s>]{0,255}>|(DOC>)|(/DOC>)|(/DOCNO>))")
_TAG = len(b"</DOCNO>")
# A tag without an end is followed over so many bytes.
_TAIL = 1024
BLOCK = 4 * 1024 * 1024
LONGEST = 32 * 1024 * 1024


@dataclass
class Piece:
    """Bytes of one document; a longer one comes in several, all but one unfinished."""

    begin: int
    part: int
    data: bytes
    ended: bool
    whole: bool


class Bytes:
    """A window over a file that only moves on; dropped bytes go with the next read."""

    def __init__(self, read: Callable[[int], bytes], at: int):
        self.read, self.begin, self.done = read, at, False
        self.base, self.data = at, b""

    @property
    def end(self) -> int:
        return self.base + len(self.data)

    def more(self, block: int) -> None:
        new = self.read(block)
        self.done = not new
        self.data = self.data[self.begin - self.base :] + new
        self.base = self.begin

    def take(self, size: int) -> bytes:
        at = self.begin - self.base
        self.begin += size
        return self.data[at : at + size]

    def drop(self, to: int) -> None:
        self.begin = max(self.begin, to)


def _events(window: Bytes, block: int) -> Iterator[tuple[str, int, int]]:
    """``(kind, start, end)`` of real tags in order, ``("read", end, end)`` whenever all
    up to there was seen, and ``("end", …)`` at last. What the caller has dropped is gone
    for good; the bytes behind a ``read`` must stay."""
    at, comment = window.begin, False
    while True:
        window.more(block)
        data, base = window.data, window.base
        # Every event ends in the last one at the latest.
        last = data.rfind(b">", max(0, at - base))
        if last >= 0:
            if comment:
                at, comment = base + data.index(b">", max(0, at - base)) + 1, False
            for m in _EVENT.finditer(data, at - base, last + 1):
                if m.lastindex:
                    yield ("start", "stop", "number")[m.lastindex - 1], base + m.start(), base + m.end()
            at = base + last + 1
        if window.done:
            yield "end", window.end, window.end
            return
        if window.end - at > _TAIL:
            # No tag is as long; of what cannot end here only a comment matters.
            comment = comment or data.find(b"<!", at - base) >= 0
            at = window.end if comment else window.end - _TAIL
        yield "read", at, at


def boundaries(window: Bytes, block: int = BLOCK) -> Iterator[tuple[str, int]]:
    """``("begin", offset)`` wherever a document begins, the first byte aside;
    ``("read", offset)`` when no document can begin before it any more, and
    ``("end", offset)``."""
    waiting = None
    for kind, start, end in _events(window, block):
        if kind == "number" and waiting is not None:
            yield "begin", waiting
            waiting = None
        elif kind == "start":
            waiting = start
        elif kind == "stop":
            waiting = None
            yield "begin", end
        elif kind == "read":
            yield "read", start if waiting is None else waiting
        elif kind == "end":
            yield "end", end


def pieces(
    read: Callable[[int], bytes],
    at: int,
    begin: int,
    end: int | None,
    block: int = BLOCK,
    longest: int = LONGEST,
) -> Iterator[Piece]:
    """The documents that begin in ``[begin, end)``, read from ``at`` on, which must be
    the start of the file or stand behind a ``>``, and early enough to see a tag that
    ends at ``begin``."""
    window = Bytes(read, at)
    open_at, part = (0, 0) if begin == 0 else (None, 0)

    def cut(to: int, ended: bool) -> Iterator[Piece]:
        nonlocal part
        while open_at is not None and to > window.begin:
            size = min(to - window.begin, longest)
            whole = ended and part == 0 and size == to - window.begin
            last = ended and size == to - window.begin
            yield Piece(open_at, part, window.take(size), last, whole)
            part += 1

    for kind, place in boundaries(window, block):
        if kind == "begin":
            yield from cut(place, True)
            if end is not None and place >= end:
                return
            open_at, part = (place, 0) if place >= begin else (None, 0)
            window.drop(place)
        elif kind == "read":
            if open_at is None:
                if end is not None and place >= end:
                    return
                window.drop(place)
            elif place - window.begin > longest:
                # Pieces of a fixed size, so that splits do not matter, and a rest to end with.
                yield from cut(window.begin + (place - window.begin - 1) // longest * longest, False)
        else:
            yield from cut(place, True)


def look_back(read_at: Callable[[int, int], bytes], begin: int, block: int = 1 << 16) -> int:
    """Where to start reading so that what begins at ``begin`` is seen: behind the last
    ``>`` before a tag that could end there."""
    at = max(0, begin - _TAG)
    while at > 0:
        start = max(0, at - block)
        found = read_at(start, at - start).rfind(b">")
        if found >= 0:
            return start + found + 1
        at = start
        if begin - at > LONGEST:
            break
    return at
