"""Hierarchical multi-length packing of tokenised documents.

A task tokenises its documents as they stream by and packs them in pools of about `POOL` tokens:
  1. Route: the leading whole multiples of the longest window leave a document as full windows; the rest goes to
     the smallest tier (context size) that holds it.
  2. Pack: within each tier, longest first, a piece goes to the fullest open window that still holds it.
  3. Fill: gaps of the longest windows are filled from shorter tiers' pieces, then by cutting one piece to
     the gap, so that only the last window of a pool may keep one; windows of a shorter tier that are not
     exactly full (a power of two) are merged upwards in the same way.
  4. Balance: each length counts its own windows through the whole task, and every `STEP` of them are a step group, so
     that a group holds one length and carries `STEP` times its tokens; only the last group of a length is smaller.
What a pool leaves unfilled is carried into the next pool of the task; a task keeps at most one padded
window. Pieces of a task number their sequences under the task's partition, so nothing is shuffled and a
repeated task gives the same rows.

Defined results: a null text is empty; an empty text has only the end id; repeated rows are packed one by
one; tokens are those of the vocabulary file, plus `END` per document; other columns are not read.
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm import common

TIERS = (256, 512, 1024, 2048)
LONGEST = TIERS[-1]
POOL = 400_000
STEP = 64
END = 1
#: Sequences of one partition at most (the partition's number stands above).
SPAN = 1 << 40
#: Latin text that normalisation leaves alone (but for case), and the vocabulary's own split pattern
#: (fixed values) for such text after lower-casing; white space is dropped.
_PLAIN = re.compile(r"[A-Za-z0-9À-ÖØ-öø-ÿ\t\n\x0b\x0c\r !-/:-@\[-`{-~«»‐-‧]*\Z")
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t\n\x0b\x0c\r a-z0-9ß-öø-ÿ]+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte (a fixed rule)."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class WordIds(dict):
    """word -> its ids as bytes; words recur, so each is encoded once. Two generations bound the memory."""

    LIMIT = 150_000

    def __init__(self, model) -> None:
        self.model, self.letters, self.old = model, _byte_letters(), {}

    def __missing__(self, word: str) -> bytes:
        got = self.old.get(word)
        if got is None:
            marks = word.encode().decode("latin-1").translate(self.letters)
            got = array("I", [t.id for t in self.model.tokenize(marks)]).tobytes()
        if len(self) >= self.LIMIT:
            self.old = dict(self)
            self.clear()
        self[word] = got
        return got


class Tokens:
    """Texts -> ids."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.words = WordIds(self.whole.model)

    def __call__(self, text: str) -> np.ndarray:
        # outside plain Latin text, normalisation may join words or change them: the tokenizer sees the whole
        if not _PLAIN.match(text) or "<|" in text:
            return np.array([*self.whole.encode(text, add_special_tokens=False).ids, END], np.uint32)
        ids = b"".join(map(self.words.__getitem__, _SPLIT.findall(text.lower())))
        return np.append(np.frombuffer(ids, np.uint32), np.uint32(END))


class Piece:
    __slots__ = ("doc", "ids", "start", "total")

    def __init__(self, doc, total: int, start: int, ids: np.ndarray) -> None:
        self.doc, self.total, self.start, self.ids = doc, total, start, ids

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.total, self.start, self.ids[:n]), Piece(self.doc, self.total, self.start + n, self.ids[n:])


def best_fit(pieces: list[Piece], size: int) -> list[list[Piece]]:
    """Longest first, each to the fullest window that holds it."""
    room: list[tuple[int, int]] = []  # (free, window), sorted
    windows: list[list[Piece]] = []
    for p in sorted(pieces, key=lambda p: -len(p.ids)):
        n = len(p.ids)
        at = bisect.bisect_left(room, (n, -1))
        if at < len(room):
            free, w = room.pop(at)
        else:
            free, w = size, len(windows)
            windows.append([])
        windows[w].append(p)
        if free > n:
            bisect.insort(room, (free - n, w))
    return windows


def length_of(window: list[Piece]) -> int:
    return sum(len(p.ids) for p in window)


def pack(pieces: list[Piece]) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows (of a tier's length), and the pieces that are left (under one longest window)."""
    done: list[list[Piece]] = []
    tiers: dict[int, list[Piece]] = {t: [] for t in TIERS}
    for p in pieces:
        while len(p.ids) >= LONGEST:
            head, p = p.cut(LONGEST)
            done.append([head])
        if len(p.ids):
            tiers[next(t for t in TIERS if t >= len(p.ids))].append(p)
    open_long: list[list[Piece]] = []
    spare: list[Piece] = []
    for t in TIERS:
        for w in best_fit(tiers[t], t):
            if length_of(w) == t:
                done.append(w)
            elif t == LONGEST:
                open_long.append(w)
            else:
                spare += w
    # gaps of the long windows: the longest spare piece that fits, again and again, then a cut one
    spare.sort(key=lambda p: len(p.ids))
    sizes = [len(p.ids) for p in spare]

    def take(at: int) -> Piece:
        sizes.pop(at)
        return spare.pop(at)

    def put(p: Piece) -> None:
        at = bisect.bisect_left(sizes, len(p.ids))
        sizes.insert(at, len(p.ids))
        spare.insert(at, p)

    left: list[Piece] = []
    open_long.sort(key=length_of, reverse=True)
    while open_long or sum(sizes) >= LONGEST:
        w = open_long.pop(0) if open_long else []
        free = LONGEST - length_of(w)
        while free and sizes:
            at = bisect.bisect_right(sizes, free) - 1
            if at < 0:
                head, tail = take(0).cut(free)
                put(tail)
            else:
                head = take(at)
            w.append(head)
            free -= len(head.ids)
        while free and open_long:  # no shorter piece is left: cut the emptiest long window
            other = open_long[-1]
            head = other.pop()
            if len(head.ids) > free:
                head, tail = head.cut(free)
                other.append(tail)
            if not other:
                open_long.pop()
            w.append(head)
            free -= len(head.ids)
        if free:
            left += w
        else:
            done.append(w)
    return done, left + spare


def tail_windows(pieces: list[Piece]) -> list[list[Piece]]:
    """The last pieces of a task: windows of exactly a power of two as long as there are tokens for one of at least the shortest tier; the rest pads one window."""
    out, queue = [], list(pieces)
    total = length_of(queue)
    for t in reversed(TIERS):
        while total >= t:
            w, free = [], t
            while free:
                p = queue.pop(0)
                if len(p.ids) > free:
                    p, rest = p.cut(free)
                    queue.insert(0, rest)
                w.append(p)
                free -= len(p.ids)
            out.append(w)
            total -= t
    return out + ([queue] if queue else [])


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_group"]
SCHEMA = ", ".join(f"{c} bigint" for c in COLUMNS)


class Numbering:
    """Sequence ids and step groups of a task's windows."""

    def __init__(self, base: int) -> None:
        self.next, self.made = base, dict.fromkeys(TIERS, 0)

    def rows(self, windows: list[list[Piece]]) -> pa.RecordBatch:
        out: list[tuple] = []
        for w in windows:
            at, tier = 0, next(t for t in TIERS if t >= length_of(w))
            group = self.made[tier] // STEP * len(TIERS) + TIERS.index(tier)
            for p in w:
                n = len(p.ids)
                out.append((p.doc, p.start, n, zlib.crc32(p.ids.astype("<u4").tobytes()), p.total, self.next, at, tier, group))
                at += n
            self.next += 1
            self.made[tier] += 1
        values = zip(*out, strict=True) if out else [()] * len(COLUMNS)
        return common.batch_of(**{c: pa.array(v, pa.int64()) for c, v in zip(COLUMNS, values, strict=True)})


def pack_documents(docs: DataFrame, vocabulary: str | None = None, pool: int = POOL) -> DataFrame:
    """A row for each piece: COLUMNS (window: the tier; step_group: within the partition, of one window each)."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, numbers = Tokens(path), Numbering(TaskContext.get().partitionId() * SPAN)
        held: list[Piece] = []
        size = 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("body").to_pylist(), strict=True):
                ids = tokens(text or "")
                held.append(Piece(doc, len(ids), 0, ids))
                size += len(ids)
                if size >= pool:
                    windows, held = pack(held)
                    yield numbers.rows(windows)
                    size = length_of(held)
        windows, held = pack(held)
        yield numbers.rows(windows + tail_windows(held))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("body"))
    return rows.mapInArrow(common.released(run), SCHEMA)


def query(docs: DataFrame) -> DataFrame:
    return pack_documents(docs)
