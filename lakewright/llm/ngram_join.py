"""N-gram Jaccard join: documents whose word-shingle sets reach a similarity, found by prefix filters under
several global token orders whose candidates are intersected before an exact verification.

How it goes
  1. One scan counts, over all documents, the shingle hashes in a fixed-size table of counters (a table for each task,
     in slices, summed by rounds of `FAN` at a time) and gives each document its set size and a 128-bit key of its set.
     Documents of one key form a class (its first half names it while candidates are sought); copies meet in one
     partial aggregation and are never compared again.
  2. A second scan emits each class's prefix under the first order (counter on a logarithmic scale, then hash: rare
     first). Two sets that reach the threshold share at least one token of these prefixes.
  3. Tokens that the same classes share are one bucket. Buckets of more than `SMALL` classes come first: every member
     meets two pivots, the member that most such buckets share and one by hash, which is linear in the bucket. Members
     that links have joined need not meet any more: what is left are those outside of the bucket's largest
     component, against all members of a size that can reach (`band`). These are dealt to blocks of at most `BLOCK`
     classes and about `BLOCK_TOKENS` tokens, compared by matrix product; a spanning forest of the links leaves a task.
  4. The other buckets give pairs, filtered by set size and without those that are joined already.
  5. Pairs must share prefix tokens under a second and third order (hash ascending and descending) as well,
     and those of step 4 pass an upper bound of the intersection from counts in 256 bins, before the whole sets meet.
  6. Links between classes are closed to components by repeated minimum and pointer jumping.

The counters only decide the order of tokens, so a collision costs time and never a link; far above their number of
tokens, what stands out of a counter is still told from what does not. Shingles are compared as 64-bit hashes (a false
link needs many collisions within one pair of sets).

Defined results: null texts and texts without words have an empty set, link with nothing and are their own
component; fewer than `n` words make one shingle; repeated rows fall into one class; the component is
the smallest non-null doc_id reachable. Other columns are not read. Ids may be null or repeated: `stage` then decides
by row (see there).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm import common

#: A bucket of so many classes at most is turned into pairs at once.
SMALL = 64
#: Classes, and tokens of their sets (as an expectation), in one block of a larger bucket.
BLOCK, BLOCK_TOKENS = 512, 2_000_000
#: Slices of the counter table, and tables that are summed at a time.
SLICES, FAN = 64, 64
#: A pivot's members are dealt over so many salts; sets of all pivots that may be broadcast.
SALTS, PIVOT_BYTES = 32, 32 << 20
#: Links that one task reduces to stars.
PART = 200_000
#: Counters: about one per `LOAD` shingles, a power of two between these.
LOAD, MIN_BITS, MAX_BITS = 32, 16, 26


class Shingler:
    """Whole text -> sorted distinct 64-bit shingle hashes."""

    def __init__(self, n: int) -> None:
        self.n = n
        self.hashes = common.WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = common.SPACE_WORDS.findall(text.encode("utf-8", "replace").lower()) if text else []
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < self.n:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
        h = self.hashes.array(words)
        x = h[: len(h) - self.n + 1]
        for k in range(1, self.n):
            x = common.mix(x, h[k : len(h) - self.n + 1 + k])
        return np.unique(x)


def key_of(x: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(x.tobytes())


def short_of(key: bytes) -> int:
    """The key's first half, which names the class while candidates are sought."""
    return int.from_bytes(key[:8], "little", signed=True)


def prefix_size(n: int, percent: int) -> int:
    """Any set that reaches percent/100 with one of n shingles shares one of this many first tokens."""
    return n - -(-percent * n // 100) + 1


_SCANNED = "doc_id bigint, size int, key binary, short bigint, part int, task int, counts binary"
_TYPES = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]


def _scanned(n: int, **columns) -> pa.RecordBatch:
    names = [x.split()[0] for x in _SCANNED.split(", ")]
    whole = {c: columns.get(c, [None] * n) for c in names}
    return common.batch_of(**{c: v if isinstance(v, pa.Array) else pa.array(v, t) for (c, v), t in zip(whole.items(), _TYPES, strict=True)})


def _packed(counts: np.ndarray) -> bytes:
    """Counters by byte planes: the upper ones of most tables are all zero."""
    return zlib.compress(np.ascontiguousarray(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _scan_one(n: int, bits: int):
    """Rows of two kinds: documents (key, size), and slices of the task's counters."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts, task = Shingler(n), np.zeros(1 << bits, np.uint32), TaskContext.get().partitionId()
        for batch in batches:
            sets = [shingles(t) for t in batch.column("body").to_pylist()]
            if sets and len(every := np.concatenate(sets)):
                slot, times = np.unique(every >> np.uint64(64 - bits), return_counts=True)
                counts[slot.astype(np.int64)] += times.astype(np.uint32)
            keys = [key_of(x) if len(x) else None for x in sets]
            shorts = [None if k is None else short_of(k) for k in keys]
            yield _scanned(len(sets), doc_id=batch.column("doc_id"), size=[len(x) for x in sets], key=keys, short=shorts)
        rows = [(k, x) for k, x in enumerate(np.split(counts, SLICES)) if x.any()]
        if rows:
            yield _scanned(len(rows), part=[k for k, _ in rows], task=[task] * len(rows), counts=[_packed(x) for _, x in rows])

    return scan


def _sum_slices(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(1, np.int64)
    for raw in pdf["counts"]:
        total = total + _unpacked(raw)
    return pd.DataFrame({"part": [pdf["part"].iloc[0]], "task": [pdf["task"].iloc[0] // FAN], "counts": [_packed(np.minimum(total, 2**32 - 1))]})


def _summed(slices: DataFrame) -> list[tuple[int, bytes]]:
    """The whole table, in slices, as two-byte logarithms."""
    tasks = (slices.agg(F.max("task")).first()[0] or 0) + 1
    while True:
        slices = slices.groupBy("part", F.floor(F.col("task") / FAN).alias("few")).applyInPandas(_sum_slices, "part int, task int, counts binary")
        tasks = -(-tasks // FAN)
        if tasks == 1:
            break
    scaled = []
    for r in slices.select("part", "counts").toLocalIterator():  # at most 2 ** MAX_BITS counters
        counts = _unpacked(r["counts"])
        scaled.append((r["part"], zlib.compress(np.minimum(np.rint(np.log2(1.0 + counts) * 2048), 65535).astype(np.uint16).tobytes(), 1)))
    return scaled


def _prefixes(n: int, bits: int, percent: int, sent):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(n)
        counts = np.zeros((SLICES, (1 << bits) // SLICES), np.uint16)
        for part, raw in sent.value:
            counts[part] = np.frombuffer(zlib.decompress(raw), np.uint16)
        counts = counts.reshape(-1)
        for batch in batches:
            tokens, keys, sizes, seen = [], [], [], set()
            for body in batch.column("body").to_pylist():
                x = shingles(body)
                if not len(x) or (key := key_of(x)) in seen:
                    continue
                seen.add(key)
                k = prefix_size(len(x), percent)
                order = np.lexsort((x, counts[(x >> np.uint64(64 - bits)).astype(np.int64)]))[:k]
                tokens.append(x[order].view(np.int64))
                keys.append(np.full(k, short_of(key), np.int64))
                sizes.append(np.full(k, len(x), np.int32))
            if tokens:
                yield common.batch_of(token=pa.array(np.concatenate(tokens)), short=pa.array(np.concatenate(keys)), size=pa.array(np.concatenate(sizes)))

    return scan


BINS = 256


def summary_of(x: np.ndarray, percent: int) -> bytes:
    """Prefixes under the orders two and three as 32-bit tokens, then counts in bins (capped at 255 = unknown)."""
    k = prefix_size(len(x), percent)
    bins = np.minimum(np.bincount((x & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS), 255).astype(np.uint8)
    half = ((x >> np.uint64(8)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return bins.tobytes() + half[:k].tobytes() + half[-k:].tobytes()


def may_reach(a: bytes, na: int, b: bytes, nb: int, percent: int) -> bool:
    ka, kb = prefix_size(na, percent), prefix_size(nb, percent)
    x, y = np.frombuffer(a, np.uint32, offset=BINS), np.frombuffer(b, np.uint32, offset=BINS)
    if not np.isin(x[:ka], y[:kb]).any() or not np.isin(x[ka:], y[kb:]).any():
        return False
    c, d = np.frombuffer(a, np.uint8, BINS), np.frombuffer(b, np.uint8, BINS)
    if max(c.max(), d.max()) == 255:
        return True
    most = int(np.minimum(c, d).sum())
    return 100 * most >= percent * (na + nb - most)


def reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Exact, for sorted sets; first by the prefixes under the orders two and three."""
    a, b = prefix_size(len(x), percent), prefix_size(len(y), percent)
    if not np.isin(x[:a], y[:b]).any() or not np.isin(x[-a:], y[-b:]).any():
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _filter_pairs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in batches:
            sides = [p.column(c).to_pylist() for c in ("sum_a", "size_a", "sum_b", "size_b")]
            yield p.select(["a", "b"]).filter(pa.array([may_reach(*x, percent) for x in zip(*sides, strict=True)], pa.bool_()))

    return run


def _verify_pairs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in batches:
            sides = [p.column(c).to_pylist() for c in ("set_a", "set_b")]
            ok = [reaches(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent) for a, b in zip(*sides, strict=True)]
            yield common.batch_of(a=p.column("key_a"), b=p.column("key_b")).filter(pa.array(ok, pa.bool_()))

    return run


def _forest(link: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    new, edges = np.ones(len(link), bool), []
    for root in range(len(link)):
        if not new[root]:
            continue
        new[root] = False
        front = [root]
        while front:
            i = front.pop()
            fresh = np.flatnonzero(link[i] & new)
            new[fresh] = False
            edges += [(i, int(j)) for j in fresh]
            front += fresh.tolist()
    return edges


def _meet(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """The links of a group's first block (`first`) with the whole group, as a spanning forest."""
    pdf = pdf.sort_values("first", ascending=False, kind="stable").drop_duplicates("key")
    lead, sets = int(pdf["first"].sum()), [np.frombuffer(x, np.uint64) for x in pdf["set"]]
    m, sizes = len(sets), np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(m), sizes)
    _, word, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[word]
    owner, word = owner[keep], number[word[keep]]
    order = np.argsort(word, kind="stable")
    owner, word = owner[order], word[order]
    both = np.zeros((lead, m), np.float32)
    step = 4096
    for low in range(0, int(shared.sum()), step):
        a, b = np.searchsorted(word, [low, low + step])
        dense = np.zeros((m, step), np.float32)
        dense[owner[a:b], word[a:b] - low] = 1
        both += dense[:lead] @ dense.T
    link = np.zeros((m, m), bool)
    link[:lead] = 100 * both >= percent * (sizes[:lead, None] + sizes[None, :] - both)
    link |= link.T
    np.fill_diagonal(link, False)
    pairs, keys = _forest(link), pdf["key"].tolist()
    return pd.DataFrame({"a": [keys[i] for i, _ in pairs], "b": [keys[j] for _, j in pairs]})


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A part's links as one star around the smallest key of each of its components."""
    up: dict = {}
    kind = None

    def root(x):
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    for batch in batches:
        kind = batch.column("a").type
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    rows = [(x, r) for x in list(up) if (r := root(x)) != x]
    if rows:
        yield common.batch_of(a=pa.array([x for x, _ in rows], kind), b=pa.array([r for _, r in rows], kind))


def components(links: DataFrame, tag: str = "cc") -> DataFrame:
    """(a, b) links over orderable keys -> (key, root): the smallest key of each component, for keys with a link.

    Parts of `PART` links are first reduced to stars, which leaves at most a link for each key of a part.
    """
    links = common.cut(links.select("a", "b"), tag)
    parts = -(-links.count() // PART) or 1
    stars = links.repartition(parts).mapInArrow(common.released(_stars), links.schema)
    edges = common.cut(stars.union(stars.select("b", "a")).distinct(), tag)
    common.forget(links)
    labels = common.cut(edges.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("m")).select("key", F.least("key", "m").alias("root")), tag)
    while True:
        near = edges.join(labels.withColumnRenamed("key", "b"), "b").groupBy(F.col("a").alias("key")).agg(F.min("root").alias("near"))
        step = common.cut(labels.join(near, "key").select("key", F.col("root").alias("old"), F.least("root", "near").alias("root")), tag)
        jump = step.alias("s").join(step.select(F.col("key").alias("root"), F.col("root").alias("far")), "root", "left")
        fresh = common.cut(jump.select("key", "old", F.least("root", F.coalesce("far", "root")).alias("root")), tag)
        moved = fresh.filter("root <> old").limit(1).count()
        common.forget(step, labels)
        labels = fresh
        if not moved:
            common.forget(edges)
            out = labels.select("key", "root")
            out.lakewright_path = labels.lakewright_path
            return out


def classes(docs: DataFrame, n: int, percent: int, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, size, key) and (key, root) for the classes that have a link."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(common.quoted(text)).cast("string").alias("body"))
    chars = rows.agg(F.sum(F.length("body"))).first()[0] or 0  # a shingle starts at every word, of about 6 characters
    bits = min(MAX_BITS, max(MIN_BITS, int(chars / 6 / LOAD).bit_length()))
    one = common.cut(rows.mapInArrow(common.released(_scan_one(n, bits)), _SCANNED), "shingles")
    members = one.filter("part is null").select("doc_id", "size", "key", "short")
    sent = spark.sparkContext.broadcast(_summed(one.filter("part is not null").select("part", "task", "counts")))
    prefix = common.cut(rows.mapInArrow(common.released(_prefixes(n, bits, percent, sent)), "token bigint, short bigint, size int"), "prefix")
    twice = prefix.groupBy("token").count().filter("count > 1").select("token")
    shared = common.cut(prefix.join(twice, "token").groupBy("token", "short").agg(F.first("size").alias("size")), "shared")
    common.forget(prefix)
    # tokens with the same members are one bucket: they agree in number and in two sums of hashes
    sums = shared.groupBy("token").agg(
        F.count("*").alias("m"), F.sum(F.xxhash64("short") % (1 << 40)).alias("s1"), F.sum(F.xxhash64("short", F.lit(7)) % (1 << 40)).alias("s2")
    )
    chosen = common.cut(sums.filter("m > 1").groupBy("m", "s1", "s2").agg(F.min("token").alias("token")).select("token", "m"), "buckets")
    placed = common.cut(shared.join(chosen, "token"), "placed")
    common.forget(shared, chosen)
    hot, sets, links, roots = placed.filter(F.col("m") > SMALL), None, None, None
    if hot.limit(1).count():
        sets = common.cut(_sets(rows, members, hot.select("short").distinct(), n, percent), "sets")
        links, roots = _large(hot.select("token", "short", "size"), sets, percent)
    # then pairs of the small ones, but for those that are joined already
    small = placed.filter(F.col("m") <= SMALL)
    small = small.withColumn("root", F.lit(None).cast("binary")) if roots is None else small.join(roots, "short", "left")
    listed = small.groupBy("token").agg(F.sort_array(F.collect_list(F.struct("size", "short", "root"))).alias("all"))
    first = listed.select(F.posexplode("all").alias("at", "x"), "all")
    # sorted by size: partners are those behind, up to the largest size that can still reach
    partners = F.filter(
        F.slice("all", F.col("at") + 2, F.lit(SMALL)),
        lambda y: (y["size"] * percent <= F.col("x")["size"] * 100) & ~F.coalesce(y["root"] == F.col("x")["root"], F.lit(False)),
    )
    pairs = first.select(F.col("x")["short"].alias("p"), F.explode(partners).alias("y")).select(
        F.least("p", F.col("y")["short"]).alias("a"), F.greatest("p", F.col("y")["short"]).alias("b")
    )
    pairs = common.cut(pairs.distinct(), "pairs")
    common.forget(placed)
    needed = pairs.select(F.col("a").alias("short")).union(pairs.select("b")).distinct()
    if sets is not None:
        needed = needed.join(sets.select("short"), "short", "left_anti")
    more = common.cut(_sets(rows, members, needed, n, percent), "sets")
    every = more if sets is None else sets.unionByName(more)
    side = lambda x, what: every.select(F.col("short").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in what])
    likely = pairs.join(side("a", ("summary", "size")), "a").join(side("b", ("summary", "size")), "b")
    likely = likely.select("a", "b", F.col("summary_a").alias("sum_a"), "size_a", F.col("summary_b").alias("sum_b"), "size_b")
    likely = common.cut(likely.mapInArrow(common.released(_filter_pairs(percent)), "a bigint, b bigint").distinct(), "likely")
    common.forget(pairs)
    found = likely.join(side("a", ("key", "set")), "a").join(side("b", ("key", "set")), "b").select("key_a", "set_a", "key_b", "set_b")
    found = common.cut(found.mapInArrow(common.released(_verify_pairs(percent)), "a binary, b binary"), "found")
    common.forget(likely, more, *([sets, roots] if sets is not None else []))
    out = components(found if links is None else found.union(links))
    common.forget(found, *([] if links is None else [links]))
    return members, out


def _large(hot: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b: keys) that join all that the large buckets link, and (short, root) of the classes that they join."""
    hot = common.cut(hot, "hot")
    often = hot.groupBy("short").agg(F.count("*").alias("n"))
    mix = F.xxhash64("short", F.lit(11))
    pivots = hot.join(often, "short").groupBy("token").agg(F.max(F.struct("n", mix.alias("x"), "short"))["short"].alias("p"), F.max(F.struct(mix.alias("x"), "short"))["short"].alias("q"))
    pivots = pivots.select("token", F.explode(F.array_distinct(F.array("p", "q"))).alias("pivot"))
    # a bucket may hold a third of all classes: its members go over salts
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    dealt = hot.withColumn("salt", F.pmod(F.xxhash64("short", F.lit(5)), F.lit(SALTS)).cast("int"))
    pairs = dealt.join(pivots.select("token", "pivot", salts), ["token", "salt"]).filter("short <> pivot").select("short", "pivot", "salt").distinct()
    own = sets.select("short", F.col("key").alias("key_a"), F.col("set").alias("set_a"), F.col("size").alias("size_a"))
    other = sets.join(pivots.select(F.col("pivot").alias("short")).distinct(), "short", "left_semi")
    other = common.cut(other.select(F.col("short").alias("pivot"), F.col("key").alias("key_b"), F.col("set").alias("set_b"), F.col("size").alias("size_b")), "pivots")
    if (other.agg(F.sum("size_b")).first()[0] or 0) * 8 <= PIVOT_BYTES:  # then the members' sets need no second shuffle
        met = pairs.join(own, "short").join(F.broadcast(other), "pivot")
    else:
        met = pairs.join(own, "short").join(other.select("*", salts), ["pivot", "salt"])
    reach = F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent
    met = met.filter(reach).select("key_a", "set_a", "key_b", "set_b")
    links = common.cut(met.mapInArrow(common.released(_verify_pairs(percent)), "a binary, b binary"), "links")
    common.forget(other)
    roots = _rooted(links, sets)
    # a group is a bucket's classes of one size band and the next: sets of other sizes cannot reach
    width = float(np.log(100 / percent)) if percent < 100 else 1.0
    band = F.floor(F.log("size") / F.lit(width) + F.lit(1e-9))
    largest = hot.join(hot.groupBy("token").agg(F.count("*").alias("m")), "token").groupBy("short").agg(F.max(F.struct("m", "token"))["token"].alias("large"))
    placed = hot.join(roots, "short", "left").join(largest, "short").select(
        "token", "short", "size", F.coalesce(F.hex("root"), F.col("short").cast("string")).alias("root"),
        F.when(F.col("large") == F.col("token"), F.concat(F.lit("s"), "short")).otherwise(F.col("large").cast("string")).alias("large"),
        F.explode(F.array(band, band - 1)).alias("band"),
    )
    keys = ["token", "band"]
    most = lambda c: placed.groupBy(*keys, c).agg(F.count("*").alias("n")).groupBy(*keys).agg(F.max(F.struct("n", c))[c].alias(f"most_{c}"))
    told = placed.join(most("root").join(most("large"), keys), keys)
    in_root, in_large = F.col("root") == F.col("most_root"), F.col("large") == F.col("most_large")
    told = told.select(*keys, "short", "size", F.when(~in_root & ~in_large, "c").when(~in_root, "a").when(~in_large, "b").otherwise("d").alias("kind"))
    blocks = lambda when: F.ceil(F.greatest(F.count_if(when) / BLOCK, F.sum(F.when(when, F.col("size")).otherwise(0)) / BLOCK_TOKENS)).cast("long")
    kind = F.col("kind")
    groups = told.groupBy(*keys).agg(blocks(kind == "c").alias("nc"), blocks(kind != "c").alias("ne"), blocks(kind == "a").alias("na"), blocks(kind == "b").alias("nb"))
    groups = common.cut(groups.filter("nc > 0 or na > 0 and nb > 0"), "groups")
    if not groups.limit(1).count():
        common.forget(hot, groups)
        return links, roots
    dealt = told.join(groups, keys).select(*keys, "short", F.explode(_meetings()).alias("to"))
    dealt = dealt.select(*keys, "short", "to.*").join(sets.select("short", "key", "set"), "short")
    met = dealt.groupBy(*keys, "what", "i", "j").applyInPandas(lambda pdf: _meet(pdf, percent), "a binary, b binary")
    every_link = common.cut(links.union(met), "links")
    common.forget(hot, groups, links, roots)
    return every_link, _rooted(every_link, sets)


def _meetings() -> Column:
    """Where a class of a group goes: structs (what, i, j, first). Blocks of `c` meet each other (what 0) and those of all
    the rest (1), blocks of `a` meet those of `b` (2); `first` is the side whose rows are compared with the whole group."""
    own = lambda n: F.pmod(F.xxhash64("short", F.lit(3)), F.greatest(F.col(n), F.lit(1)))
    none = "array<struct<what:int,i:bigint,j:bigint,first:boolean>>"

    def to(what: int, n: str, i, j, first) -> Column:
        one = lambda k: F.struct(F.lit(what).alias("what"), i(k).alias("i"), j(k).alias("j"), first(k).alias("first"))
        return F.when(F.col(n) > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col(n) - 1), one)).otherwise(F.array().cast(none))

    yes, no, other = (lambda k: F.lit(True)), (lambda k: F.lit(False)), (lambda k: k)
    c, e, a, b = (own(n) for n in ("nc", "ne", "na", "nb"))
    among = to(0, "nc", lambda k: F.least(c, k), lambda k: F.greatest(c, k), lambda k: c <= k)
    rest = to(1, "nc", other, lambda k: e, no)
    kind = F.col("kind")
    return (
        F.when(kind == "c", F.concat(among, to(1, "ne", lambda k: c, other, yes)))
        .when(kind == "a", F.concat(rest, to(2, "nb", lambda k: a, other, yes)))
        .when(kind == "b", F.concat(rest, to(2, "na", other, lambda k: b, no)))
        .otherwise(rest)
    )


def _rooted(links: DataFrame, sets: DataFrame) -> DataFrame:
    """(short, root) of the classes that links join; a name that two of them share is left out."""
    closed = components(links)
    named = closed.join(sets.select("key", "short").distinct(), "key").groupBy("short")
    out = common.cut(named.agg(F.min("root").alias("root"), F.count("*").alias("n")).filter("n = 1").drop("n"), "roots")
    common.forget(closed)
    return out


def _keys(n: int):
    """Text column -> key of its set, null for an empty one."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        shingles = Shingler(n)
        for texts in batches:
            sets = [shingles(t) for t in texts]
            yield pd.Series([key_of(x) if len(x) else None for x in sets], index=texts.index, dtype=object)

    return F.pandas_udf(run, "binary")


def _sets(rows: DataFrame, members: DataFrame, needed: DataFrame, n: int, percent: int) -> DataFrame:
    """(key, short, size, set, summary) of the classes asked for, from the text of one document of each (a repeated
    row may repeat a class)."""
    few = members.filter("key is not null").groupBy("key", "short").agg(F.min("doc_id").alias("doc_id")).join(needed, "short")
    few = common.cut(few.select("key", "doc_id"), "picked")
    m = few.count()
    near = F.broadcast(few) if m <= common.BROADCAST_ROWS else few
    if few.select("doc_id").distinct().count() == m:
        picked = rows.join(near, rows["doc_id"].eqNullSafe(few["doc_id"])).select("body", "key")
    else:  # one id (or none) for several classes: each of its rows would meet all of them
        picked = rows.withColumn("key", _keys(n)("body")).join(near.select("key"), "key").select("body", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingler(n), set()
        for batch in batches:
            out = []
            for body, key in zip(batch.column("body").to_pylist(), batch.column("key").to_pylist(), strict=True):
                if key in seen:
                    continue
                x = shingles(body)
                if len(x) and key_of(x) == key:  # else another row of the same doc_id
                    seen.add(key)
                    out.append((key, short_of(key), len(x), x.tobytes(), summary_of(x, percent)))
            columns = zip(*out, strict=True) if out else [()] * 5
            kinds = {"key": pa.binary(), "short": pa.int64(), "size": pa.int32(), "set": pa.binary(), "summary": pa.binary()}
            yield common.batch_of(**{c: pa.array(v, k) for (c, k), v in zip(kinds.items(), columns, strict=True)})

    return picked.mapInArrow(common.released(run), "key binary, short bigint, size int, set binary, summary binary")


def join(docs: DataFrame, n: int = 3, percent: int = 90, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each row of docs."""
    members, roots = classes(docs, n, percent, text)
    return _joined(members, roots)


def _joined(members: DataFrame, roots: DataFrame) -> DataFrame:
    least = members.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    rooted = common.cut(least.join(roots, "key", "left").select("key", "least", F.coalesce("root", "key").alias("root")), "rooted")
    smallest = common.cut(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    named = common.cut(rooted.join(smallest, "root").select("key", "component_id"), "named")
    common.forget(rooted, smallest)
    return members.join(named, "key", "left").select(
        "doc_id", F.col("size").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def query(docs: DataFrame) -> DataFrame:
    return join(docs, 3, 90)


def stage(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component stays: the smallest doc_id, a null one last, then the smallest key. Of rows without words
    only repeats of an id's text go."""
    members, roots = classes(docs, n, percent)
    if members.groupBy("doc_id").count().filter("count > 1 or doc_id is null").limit(1).count():
        return _stage_by_row(docs, roots, n)
    found = _joined(members, roots)
    gone = common.cut(found.filter("doc_id <> component_id").select("doc_id").distinct(), "gone")
    if gone.count() <= common.BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def _stage_by_row(docs: DataFrame, roots: DataFrame, n: int) -> DataFrame:
    """stage() where doc_id does not name a row: rows go by id, key and a hash of the text."""
    keyed = common.apart(docs).withColumns({"id": F.col("row.doc_id"), "key": _keys(n)("body"), "hash": F.xxhash64("body")})
    told = keyed.filter("key is not null").select("id", "key", "hash").join(roots.select("key", "root"), "key", "left")
    best = told.groupBy(F.coalesce("root", "key").alias("root")).agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key", "hash")).alias("x"))
    best = common.cut(best.select(F.col("x.id").alias("best_id"), F.col("x.key").alias("best_key"), F.col("x.hash").alias("best_hash")), "best")
    same = (F.col("key") == F.col("best_key")) & (F.col("hash") == F.col("best_hash")) & F.col("id").eqNullSafe(F.col("best_id"))
    kept = keyed.join(best, same).dropDuplicates(["key"]).select("row", "body")
    empty = keyed.filter("key is null")
    repeated = empty.filter("id is not null").dropDuplicates(["id", "body"]).select("row", "body")
    return common.together(kept.union(repeated).union(empty.filter("id is null").select("row", "body")), docs)


SQL = r"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS (
    SELECT DISTINCT rid, array_to_string(w[i:i + least(len(w), 3) - 1], ' ') AS s FROM d, unnest(range(1, len(w) - least(len(w), 3) + 2)) AS u(i) WHERE len(w) > 0
), sizes AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid
), common_n AS (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM sh x JOIN sh y USING (s) WHERE x.rid <> y.rid GROUP BY ALL
), links AS (SELECT a, b FROM common_n JOIN sizes p ON p.rid = a JOIN sizes q ON q.rid = b WHERE 100 * c >= 90 * (p.n + q.n - c)
), reach(rid, other) AS (SELECT rid, rid FROM d UNION SELECT r.rid, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM d JOIN reach USING (rid) JOIN d o ON o.rid = reach.other LEFT JOIN sizes ON sizes.rid = d.rid GROUP BY d.rid, d.doc_id"""
