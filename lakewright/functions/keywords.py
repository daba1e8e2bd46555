"""Keyword replacement and span matching over short texts."""

from __future__ import annotations

import re

#: What a whole word ends at.
_WORD = frozenset("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz")


def _lower(text: str) -> str:
    """Lower case, character by character: each keeps its place."""
    low = text.lower()
    if len(low) == len(text) and "\u03a3" not in text:
        return low
    return "".join(x if len(x := c.lower()) == 1 else c for c in text)


class Replacer:
    """Replace keywords by their values: longest match at each place, case-insensitive.

    Only `[0-9A-Za-z_]` are word characters: a match must not have one of them on either side, so Latin keywords match whole
    words while others match anywhere. Replaced text is not looked at again. Where a keyword may start, its text of each length
    that keywords of that first character have is looked up, so the size of the dictionary does not matter.
    """

    def __init__(self, words: dict[str, str]) -> None:
        self.values = {_lower(k): v for k, v in words.items() if k}
        by_first: dict[str, set[int]] = {}
        for k in self.values:
            by_first.setdefault(k[0], set()).add(len(k))
        self.lengths = {c: sorted(n, reverse=True) for c, n in by_first.items()}
        self.start = re.compile(f"(?<![0-9A-Za-z_])[{''.join(map(re.escape, by_first))}]") if by_first else None

    def replace(self, text: str) -> str:
        if self.start is None:
            return text
        low, out, done = _lower(text), [], 0
        at = self.start.search(low)
        while at:
            here, after = at.start(), at.end()
            for n in self.lengths[low[here]]:
                end = here + n
                if end <= len(low) and low[end : end + 1] not in _WORD and (value := self.values.get(low[here:end])) is not None:
                    out += text[done:here], value
                    done = after = end
                    break
            at = self.start.search(low, after)
        return "".join((*out, text[done:]))


def ordered(terms) -> list[str]:
    """Longest first; equal lengths by code point."""
    return sorted(set(terms), key=lambda t: (-len(t), t))


class Finder:
    """One place for each term: its first one that overlaps no term found before; terms by order, at most `most` of them.

    All places are found in one walk over the text: where a term may start, the text of each length that terms of that first
    character have is looked up, so the number of terms does not matter. What is found covers marked characters, so a place is
    tested by its own length.
    """

    def __init__(self, terms: list[str]) -> None:
        self.rank = {t: k for k, t in enumerate(dict.fromkeys(terms)) if t}
        lengths: dict[str, set[int]] = {}
        for t in self.rank:
            lengths.setdefault(t[0], set()).add(len(t))
        self.lengths = {c: tuple(sorted(n)) for c, n in lengths.items()}
        self.start = re.compile(f"[{''.join(map(re.escape, lengths))}]") if lengths else None

    def spans(self, text: str, most: int = 20) -> list[tuple[str, int, int]]:
        if self.start is None:
            return []
        places: dict[str, list[int]] = {}
        for m in self.start.finditer(text):
            at = m.start()
            for n in self.lengths[m[0]]:
                if (term := text[at : at + n]) in self.rank:
                    places.setdefault(term, []).append(at)
        found, taken = [], bytearray(len(text))
        for term in sorted(places, key=self.rank.__getitem__):
            n = len(term)
            at = next((k for k in places[term] if not any(taken[k : k + n])), None)
            if at is not None:
                taken[at : at + n] = b"\1" * n
                found.append((term, at, at + n))
                if len(found) == most:
                    break
        return found


def spans(text: str, terms: list[str], most: int = 20) -> list[tuple[str, int, int]]:
    return Finder(terms).spans(text, most)
