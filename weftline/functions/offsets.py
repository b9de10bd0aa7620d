"""Where the characters of a cleaned text stand in the raw one: both are walked through once, as cleaning only drops or replaces signs."""

from __future__ import annotations


def raw_offsets(raw: str, clean: str) -> list[int]:
    """For each character of clean its place in raw, and at the end len(raw). A character that raw has further on stands there; white space also stands
    for any white space; one that raw has not from there on stands where the next one does."""
    out: list[int] = []
    at = 0
    for c in clean:
        k = at
        if c.isspace():
            while k < len(raw) and not raw[k].isspace():
                k += 1
        else:
            k = raw.find(c, at)
        if 0 <= k < len(raw):
            out.append(k)
            at = k + 1
        else:
            out.append(min(at, len(raw)))
    out.append(len(raw))
    return out


def raw_span(offsets: list[int], start: int, stop: int) -> tuple[int, int]:
    """The raw place of clean characters start to stop: from the first one to behind the last one."""
    if start >= stop:
        return offsets[start], offsets[start]
    return offsets[start], min(offsets[stop - 1] + 1, offsets[-1])
