"""Exact substring dedup by fixed-block anchors: a word goes where a window of `WINDOW` words over it also starts in a document
with a smaller id.

Index: the non-overlapping blocks of `BLOCK` words of every document. A window of 13 = 2 * 7 - 1 words holds one whole
block of the document that it is taken from, so each repeat of that length shows as a rolling 7-word probe that meets a
block. Probes: all rolling windows of 7 words of all documents, dealt to parts by their hash in packed form; a part tells
which of its blocks are met from another place. Extension: around every such block and every probe that meets one, the windows of 13
words that hold it go with two hashes (96 bits) to the smallest document that has them; the hit windows of a document
merge into its maximal repeats.

Memory: the blocks that are met come back as bits of a fixed number (`MAX_BITS`, sent to the executors); beyond that load
more windows than needed go on to the extension, which decides exactly at every size. A part holds about `PART` hashes
whatever a text repeats, since a batch sends each of its hashes once. Windows that many documents share are reduced to a
minimum before they are shuffled; the rows of those that hold over a thousandth of all windows (so under a thousand, which every executor is
told of) go over salts instead of into one task. Equal texts are settled before: only the smallest id takes part.

Defined results: null texts have no words; texts of fewer than 13 words lose none; rows without an id neither lose words nor
take any; rows with equal ids do not count as smaller to each other, repeated rows give equal rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm import common

WINDOW, BLOCK = 13, 7
#: Hashes in one part, about.
PART = 1 << 20
#: Bits that say which blocks are met from elsewhere: one for each word, at most so many.
MIN_BITS, MAX_BITS = 1 << 16, 1 << 29
#: Numbers (starts and ends of repeats) that are sent to every executor at most; beyond, the texts are shuffled to them.
SENT = 2_000_000
#: A window of more rows than a thousandth of all (and so many at least) is joined over so many salts.
HOT, SALTS = 10_000, 64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that are hashed at once.
SPAN = 1 << 18


def _powers(x: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(SPAN, np.uint64(x))]), dtype=np.uint64)


_BASE = 0x9E3779B97F4A7C15
_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
_BYTES = common.mix(np.arange(256, dtype=np.uint64), 0x51)


class Words:
    """The words of a batch of texts: `starts` and `ends` in `data` (bytes), `doc` (row of the batch), `hashes`."""

    def __init__(self, texts: pa.Array) -> None:
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        values = texts.buffers()[2]
        self.data = np.frombuffer(values, np.uint8)[at[0] : at[-1]] if values is not None and len(at) else np.zeros(0, np.uint8)
        at = at - at[0] if len(at) else np.zeros(1, np.int64)
        word = ~_SPACE[self.data]
        edge = np.zeros(len(word) + 1, bool)  # a word starts or a run of space does
        edge[1:-1] = word[1:] != word[:-1]
        edge[at] = True
        cuts = np.flatnonzero(edge)
        cuts, after = cuts[:-1], cuts[1:]
        own = word[cuts] if len(cuts) else np.zeros(0, bool)
        self.starts, self.ends = cuts[own], after[own]
        self.doc = np.searchsorted(at, self.starts, "right") - 1
        self.counts = np.bincount(self.doc, minlength=len(texts))
        #: the first word of each text, and the number of all
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    @cached_property
    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        i = 0
        with np.errstate(over="ignore"):
            while i < len(out):
                base = self.starts[i]
                j = int(np.searchsorted(self.ends, base + SPAN, "right"))
                if j <= i:  # one word longer than a span
                    out[i] = xxhash.xxh64_intdigest(self.data[base : self.ends[i]])
                    i += 1
                    continue
                part = _BYTES[self.data[base : self.ends[j - 1]]]
                sums = np.concatenate([[np.uint64(0)], np.cumsum(part * _UP[: len(part)], dtype=np.uint64)])
                a, b = self.starts[i:j] - base, self.ends[i:j] - base
                out[i:j] = common.mix((sums[b] - sums[a]) * _DOWN[a], (b - a).astype(np.uint64))
                i = j
        return out

    def rolling(self, size: int, seed: int = 0) -> np.ndarray:
        """A hash of the words i .. i + size - 1 for each i (also across texts)."""
        n = max(0, len(self.starts) - size + 1)
        out = np.full(n, seed, np.uint64)
        for j in range(size):
            out = common.mix(out, self.hashes[j : n + j])
        return out

    def inside(self, size: int) -> np.ndarray:
        """Whether these words are of one text."""
        n = max(0, len(self.starts) - size + 1)
        return self.doc[:n] == self.doc[size - 1 :][:n]


def _probes(words: Words, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, is a block of the index) of the rolling windows of BLOCK words in texts of at least WINDOW words."""
    ok = words.inside(BLOCK) & (words.counts[words.doc[: len(wide)]] >= WINDOW)
    at = np.flatnonzero(ok)
    return at, wide[at], (at - words.first[words.doc[at]]) % BLOCK == 0


def _dealt(parts: int):
    """Each batch's hashes, blocks and other probes apart, once each and packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column("body"))
            _, probes, block = _probes(words, words.rolling(BLOCK))
            blocks, times = np.unique(probes[block], return_counts=True)
            others = np.unique(np.concatenate([probes[~block], blocks[times > 1]]))
            both = [_packed(x, parts) for x in (blocks, others)]
            rows = sorted(both[0].keys() | both[1].keys())
            packs = [pa.array([x.get(p, b"") for p in rows], pa.binary()) for x in both]
            yield common.batch_of(part=pa.array(rows, pa.int32()), blocks=packs[0], others=packs[1])

    return run


def _packed(hashes: np.ndarray, parts: int) -> dict[int, bytes]:
    part, low = _place(hashes, parts)
    order = np.argsort(part, kind="stable")
    part, low = part[order], low[order]
    firsts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
    return {int(part[a]): low[a:b].tobytes() for a, b in zip(firsts, [*firsts[1:], len(part)], strict=True)}


def _place(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of a hash (a power of two of them) and what tells it from others there."""
    return (hashes >> np.uint64(32)).astype(np.int64) & (parts - 1), hashes.astype(np.uint32)


def _bits(low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two of a part's bits (2 ** width of them) for each hash."""
    wide, shift = low.astype(np.uint64), np.uint64(32 - width)
    mask = np.uint64(0xFFFFFFFF)
    return tuple((((wide * np.uint64(k)) & mask) >> shift).astype(np.int64) for k in (0x9E3779B1, 0x85EBCA77))


def _met(width: int):
    """The blocks of a part that are met from another place, as bits."""

    def run(table: pa.Table) -> pa.Table:
        blocks = np.frombuffer(b"".join(table["blocks"].to_pylist()), np.uint32)
        others = np.unique(np.frombuffer(b"".join(table["others"].to_pylist()), np.uint32))
        own, times = np.unique(blocks, return_counts=True)
        hit = (times > 1) | np.isin(own, others, assume_unique=True)
        bits = np.zeros(1 << width, bool)
        for x in _bits(own[hit], width):
            bits[x] = True
        return pa.table({"part": table["part"][:1], "bits": pa.array([np.packbits(bits).tobytes()])})

    return run


class Met:
    """Which hashes are those of blocks that are met from elsewhere (a few others may pass)."""

    def __init__(self, found: list, parts: int, width: int) -> None:
        self.parts, self.width = parts, width
        bits = np.zeros((parts, (1 << width) // 8), np.uint8)
        for part, packed in found:
            bits[part] = np.frombuffer(packed, np.uint8)
        self.bits = bits.reshape(-1)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        part, low = _place(hashes, self.parts)
        out = np.ones(len(hashes), bool)
        for x in _bits(low, self.width):
            at = (part << self.width) + x
            out &= (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return out


def _extended(sent):
    """The windows of WINDOW words that hold a block or a probe that was met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = sent.value
        for batch in batches:
            words = Words(batch.column("body"))
            at, probes, _ = _probes(words, words.rolling(BLOCK))
            marks = np.zeros(len(words.starts) + 1, np.int64)
            marks[at[met(probes)] + 1] = 1
            marks = np.cumsum(marks)  # hits before each place
            n = max(0, len(words.starts) - WINDOW + 1)
            near = marks[WINDOW - BLOCK + 1 :][:n] - marks[:n] > 0
            spots = np.flatnonzero(near & words.inside(WINDOW))
            first, second = words.rolling(WINDOW)[spots], words.rolling(WINDOW, 1)[spots]
            owner = words.doc[spots]
            yield common.batch_of(
                w=pa.array(first.view(np.int64)), v=pa.array(second.astype(np.uint32).view(np.int32)), doc_id=batch.column("doc_id").take(pa.array(owner)),
                rid=batch.column("rid").take(pa.array(owner)), at=pa.array((spots - words.first[owner]).astype(np.int32)),
            )

    return run


def _power(x: float) -> int:
    return 1 << max(0, int(x) - 1).bit_length()


def repeats(reps: DataFrame, chars: int) -> DataFrame:
    """doc_id, rid and `runs`: the words (start, end pairs, flat, merged) that a smaller id has, of rows (doc_id, rid, body)."""
    spark, kind = reps.sparkSession, reps.schema["doc_id"].dataType.simpleString()
    guess = chars / 6 + 1  # words
    parts = _power(guess / PART)
    bits = max(MIN_BITS, min(MAX_BITS, _power(guess)))
    width = min(32, max(3, (bits // parts).bit_length() - 1))
    dealt = reps.mapInArrow(common.released(_dealt(parts)), "part int, blocks binary, others binary")
    found = dealt.groupBy("part").applyInArrow(_met(width), "part int, bits binary").collect()
    sent = spark.sparkContext.broadcast(Met(found, parts, width))
    windows = reps.mapInArrow(common.released(_extended(sent)), f"w long, v int, doc_id {kind}, rid long, at int")
    shared = windows.groupBy("w", "v").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n"))
    shared = common.cut(shared.filter("least < most").select("w", "v", "least", "n"), "shared")
    total = shared.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") > max(HOT, total // 1000)
    # under a thousand windows hold over a thousandth each: their rows go over salts
    few = F.broadcast(shared.filter(hot).select("w", "v", F.lit(True).alias("hot")))
    salt = F.pmod(F.xxhash64("doc_id", "rid", "at"), F.lit(SALTS)).cast("int")
    dealt = windows.join(few, ["w", "v"], "left").withColumn("salt", F.when(F.col("hot"), salt).otherwise(0)).drop("hot")
    copies = F.explode(F.sequence(F.lit(0), F.when(hot, SALTS - 1).otherwise(0)))
    hits = dealt.join(shared.select("w", "v", "least", copies.alias("salt")), ["w", "v", "salt"]).filter("least < doc_id")
    merged = hits.groupBy("doc_id", "rid").agg(F.array_sort(F.collect_set("at")).alias("spots"))
    return merged.select("doc_id", "rid", _runs(F.col("spots")).alias("runs"))


def _runs(spots: Column) -> Column:
    """Sorted starts of hit windows to the runs of words that they cover: a start counts where no window before reaches it, an end where the next one does not."""
    near = lambda i, j: F.get(spots, i) - F.get(spots, j) <= WINDOW
    starts = F.filter(spots, lambda x, i: (i == 0) | ~near(i, i - 1))
    ends = F.transform(F.filter(spots, lambda x, i: (i == F.size(spots) - 1) | ~near(i + 1, i)), lambda x: x + WINDOW)
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.array(a, b)))


def _kept(texts: bool):
    """Words, removed words and what is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column("body"))
            gone = np.zeros(len(words.starts) + 1, np.int64)
            runs = batch.column("runs")
            for row in np.flatnonzero(runs.is_valid().to_numpy(zero_copy_only=False)).tolist():
                pairs = np.array(runs[row].as_py(), np.int64) + words.first[row]
                np.add.at(gone, pairs[::2], 1)
                np.add.at(gone, pairs[1::2], -1)
            stays = np.cumsum(gone[:-1]) == 0
            copy = np.array(batch.column("copy").to_pylist(), bool)
            stays &= ~(copy & (words.counts >= WINDOW))[words.doc]
            removed = np.bincount(words.doc[~stays], minlength=batch.num_rows)
            left = _left(words, stays, batch.num_rows)
            out = {"doc_id": batch.column("doc_id"), "n_words": pa.array(words.counts.astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64))}
            yield common.batch_of(**out, kept=pa.array([x.decode() for x in left] if texts else [hashlib.sha256(x).hexdigest() for x in left], pa.string()))

    return run


def _left(words: Words, stays: np.ndarray, n: int) -> Iterator[bytes]:
    """The words that stay of each text, joined by one space."""
    starts, ends, doc = words.starts[stays], words.ends[stays], words.doc[stays]
    last = np.concatenate([doc[1:] != doc[:-1], [True]]) if len(doc) else np.zeros(0, bool)
    data = np.append(words.data, np.uint8(0x20))
    data[ends[~last]] = 0x20  # the white space behind a word
    upto = ends + ~last
    mask = np.zeros(len(data) + 1, np.int8)
    mask[starts] += 1
    mask[upto] -= 1
    data = data[np.cumsum(mask[:-1], dtype=np.int8).astype(bool)]
    sizes = np.bincount(doc, weights=upto - starts, minlength=n).astype(np.int64)
    at = 0
    for size in sizes.tolist():
        yield data[at : at + size].tobytes()
        at += size


def dedup(docs: DataFrame, text: str = "text", texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and `kept`: the text that is left (texts) or its SHA-256."""
    body = F.coalesce(F.col(common.quoted(text)).cast("string"), F.lit(""))
    rows = docs.select("doc_id", body.alias("body")).withColumn("key", F.unhex(F.md5("body")))
    narrow = common.cut(rows.select("doc_id", "key", F.length("body").alias("chars")), "texts")
    equal = narrow.filter("doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    equal = common.cut(equal.filter("least < most").select("key", "least"), "equal")
    chars = narrow.agg(F.sum("chars")).first()[0] or 0
    told = rows.join(F.broadcast(equal) if equal.count() <= common.BROADCAST_ROWS else equal, "key", "left")
    told = told.select("doc_id", "body", F.xxhash64("body").alias("rid"), F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).alias("copy"))
    found = common.cut(repeats(told.filter("not copy and doc_id is not null").drop("copy"), chars), "repeats")
    size = found.agg(F.sum(F.size("runs") + 4)).first()[0] or 0
    with_runs = told.join(F.broadcast(found) if size <= SENT else found, ["doc_id", "rid"], "left").select("doc_id", "body", "copy", "runs")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_runs.mapInArrow(common.released(_kept(texts)), f"doc_id {kind}, n_words long, n_removed long, kept string")


def query(docs: DataFrame) -> DataFrame:
    return dedup(docs).withColumnRenamed("kept", "kept_sha256")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), wins AS (
    SELECT rid, doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM d, unnest(range(1, len(w) - 11)) AS u(i) WHERE len(w) >= 13
), firsts AS (SELECT win, min(doc_id) AS least FROM wins GROUP BY win
), gone AS (SELECT rid, list(DISTINCT j) AS js FROM wins JOIN firsts USING (win), unnest(range(i, i + 13)) AS u(j) WHERE least < doc_id GROUP BY rid
), words AS (SELECT rid, j, w[j] AS word FROM d, unnest(range(1, len(w) + 1)) AS u(j)
), hit AS (SELECT rid, unnest(js) AS j FROM gone
), kept AS (SELECT rid, string_agg(word, ' ' ORDER BY j) AS k, count(*) AS n FROM words ANTI JOIN hit USING (rid, j) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (rid)"""
