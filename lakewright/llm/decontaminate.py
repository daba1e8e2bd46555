"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, token windows of every
document scanned against it, hits verified word by word, then spans or whole documents removed.

Words are lower-cased (A-Z) runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`; a window is 10 consecutive words of an
item, or the whole item where it has fewer. The set is sent to the executors in blocks of at most
`BLOCK_WORDS` item words, one at a time: a larger benchmark takes several passes, each written to the shared
folder with its hits before the next block is sent and its own is taken back, so memory is that of one block.

Defined results: null or empty texts have no words and no hits; an item without words has no window;
equal windows of several items count for each of them; an item
without an id marks words but is not listed; repeated rows are scanned alike; other columns
are not read. The text of hit words can be cut out with `clean`, which leaves all other characters.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm import common

WINDOW = 10
#: Words of benchmark items in one broadcast at most (about 100 bytes each in memory).
BLOCK_WORDS = 1_000_000
#: On lower-cased UTF-8: every byte of a non-ASCII character belongs to a word.
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return WORDS.findall(text.encode("utf-8", "replace").lower()) if text else []


class Windows:
    """The windows of some items, by length; lookup by rolling hash, verified word by word."""

    def __init__(self, items: list[tuple[str, list[bytes]]]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.items = [k for k, _ in items]
        found: dict[int, dict[tuple[int, ...], list[int]]] = defaultdict(lambda: defaultdict(list))
        for k, (_, words) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            size = min(WINDOW, len(ids))
            for at in range(len(ids) - size + 1) if size else ():
                owners = found[size][tuple(ids[at : at + size])]
                if not owners or owners[-1] != k:
                    owners.append(k)
        self.windows = {size: dict(x) for size, x in found.items()}
        self.hashes = {size: np.unique(self.rolling(np.array(list(x), np.uint64))) for size, x in self.windows.items()}

    @staticmethod
    def rolling(rows: np.ndarray) -> np.ndarray:
        """Hash of each row of word numbers."""
        out = np.zeros(len(rows), np.uint64)
        for j in range(rows.shape[1]):
            out = common.mix(out, rows[:, j])
        return out

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit words as merged (start, end) runs, and the items that occur."""
        ids = np.fromiter(map(self.vocabulary.get, words, (0 for _ in words)), np.uint64, len(words))
        known = np.concatenate([[0], np.cumsum(ids != 0)])
        runs, items = [], set()
        for size, table in self.windows.items():
            if len(ids) < size:
                continue
            starts = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(starts):
                continue
            rows = ids[starts[:, None] + np.arange(size)]
            got = np.isin(self.rolling(rows), self.hashes[size])
            for at, row in zip(starts[got].tolist(), rows[got].tolist(), strict=True):
                if (owners := table.get(tuple(row))) is not None:
                    runs.append((at, at + size))
                    items.update(owners)
        return merged(runs), items


class Block:
    """Items as sent to the executors; a Python worker, which keeps what was sent to it, makes their windows once."""

    def __init__(self, items: list[tuple[str, list[bytes]]]) -> None:
        self.items, self.made = items, None

    def windows(self) -> Windows:
        if self.made is None:
            self.made, self.items = Windows(self.items), None
        return self.made


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _blocks(benchmark: DataFrame) -> list[DataFrame]:
    """The benchmark in parts whose words fit one broadcast each."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("body")).filter("body is not null")
    total = rows.agg(F.sum(F.length("body"))).first()[0] or 0  # words are at least one character and a gap
    n = max(1, -(-total // (2 * BLOCK_WORDS)))
    return [rows.filter(F.pmod(F.xxhash64("item", "body"), F.lit(n)) == k) if n > 1 else rows for k in range(n)]


FOUND = "n bigint, runs array<bigint>, items array<string>"


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", max_share: float | None = None) -> DataFrame:
    """docs as common.apart() has them, with `n` (words), `runs` (hit words: start, end pairs, flat) and `items` (ids, sorted).

    max_share: with `changed` instead of these, the cleaned text as `body`, and without the documents of which more
    words are hit than this share (in the last pass's Python worker).
    """
    plain, blocks = common.apart(docs, text), _blocks(benchmark)
    found, merged_schema = common.wider(plain, FOUND), common.wider(plain, FOUND if max_share is None else "changed boolean")

    def block(k: int) -> Block:
        return Block([(r["item"], words_of(r["body"])) for r in blocks[k].collect()])

    return common.in_passes(
        plain, len(blocks), block, lambda df, sent, last: df.mapInArrow(common.released(_scanner(sent, max_share if last else None)), merged_schema if last else found)
    )


def _scanner(sent, max_share: float | None):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = sent.value.windows()
        for batch in batches:
            counts, runs, items = [], [], []
            bodies, later = batch.column("body").to_pylist(), "runs" in batch.schema.names
            for k, body in enumerate(bodies):
                words = words_of(body)
                hit, who = windows.scan(words)
                own = {windows.items[i] for i in who}
                if later:  # merge with the hits of the blocks before
                    old = batch.column("runs")[k].as_py()
                    hit = merged(hit + list(zip(old[::2], old[1::2], strict=True)))
                    own |= set(batch.column("items")[k].as_py())
                counts.append(len(words))
                runs.append([x for run in hit for x in run])
                items.append(sorted(x for x in own if x is not None))
            if max_share is None:
                found = {"n": pa.array(counts, pa.int64()), "runs": pa.array(runs, pa.list_(pa.int64())), "items": pa.array(items, pa.list_(pa.string()))}
                yield common.batch_of(row=batch.column("row"), body=batch.column("body"), **found)
                continue
            stays = [sum(r[1::2]) - sum(r[::2]) <= max_share * n for r, n in zip(runs, counts, strict=True)]
            texts = [clean(t, r) if ok else None for t, r, ok in zip(bodies, runs, stays, strict=True)]
            out = common.batch_of(row=batch.column("row"), body=pa.array(texts, pa.string()), changed=pa.array([bool(r) for r in runs], pa.bool_()))
            yield out.filter(pa.array(stays, pa.bool_()))

    return scan


def clean(body: str | None, runs: list[int]) -> str | None:
    """The text without its hit words (and without the white space before each)."""
    if not body or not len(runs):
        return body
    raw = body.encode("utf-8", "replace")
    spots = [m.span() for m in WORDS.finditer(raw.lower())]
    out, last = [], 0
    for a, b in zip(runs[::2], runs[1::2], strict=True):
        start, end = spots[a][0], spots[b - 1][1]
        out.append(raw[last:start].rstrip(b" \t"))
        last = end
    return b"".join([*out, raw[last:]]).decode("utf-8")


def stage(docs: DataFrame, benchmark: DataFrame, max_share: float = 0.5) -> DataFrame:
    """Hit spans are cut out; a document that has lost over `max_share` of its words goes."""
    return common.together(find(docs, benchmark, max_share=max_share), docs)


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find(docs.select("doc_id", "text"), benchmark)
    ends = F.aggregate("runs", F.lit(0).cast("long"), lambda a, x: x - a)  # e_n - s_n + ... + e_1 - s_1
    return found.select(
        "row.doc_id",
        F.col("n").alias("n_words"),
        ends.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )


def sha256_of(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), wins AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
    FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM wins
), spots AS (
    SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS win FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS u(i) WHERE len(w) >= size
), hits AS (SELECT rid, s.size, i, item_id FROM spots s JOIN wins USING (size, win)
), hit_words AS (SELECT rid, count(DISTINCT j) AS n FROM hits, unnest(range(i, i + size)) AS u(j) GROUP BY rid
), hit_items AS (SELECT rid, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM hits GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
    sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)"""
