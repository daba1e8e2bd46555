"""Merkle manifest of a dataset: a digest for every row, a tree over each source, a tree over the sources' roots, and a
proof for every row that is folded back to the root.

Leaves are ranked within their source after one sort by range, so block k holds the leaves `BLOCK * k ...` of its source.
A block is a contiguous matrix of 64-byte hex digests; its levels come from reshaping it by `FANOUT` and hashing the
rows, and every sibling is found by index arithmetic. The roots of a source's blocks are the leaves of the next round,
until one is left; the sources' roots are then treated as one more source. On the way back each block gets the path of its
own root (a run of at most `FANOUT` digests and a place in it for each level), so a task holds one block and one path.

Defined results: null columns are `-`; leaves of one source stand by doc_id (nulls first), equal ids by their leaf, so
repeated rows have neighbouring places (their rows are equal but for the proof); an empty table gives no row; other
columns are not read. The text's length has no bound but that of a row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.llm import common

FANOUT = 16
#: Levels of a block, and leaves in it at most.
HEIGHT = 3
BLOCK = FANOUT**HEIGHT
DIGEST = 64
#: Rows with a doc_id whose crc32 this divides are tampered with in the query.
TAMPERED = 5


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*map(_field, (doc_id, source, lang, n_chars, text))), 256)


def leaves(docs: DataFrame, tamper: Column | None = None) -> DataFrame:
    """doc_id, source, leaf and `other`: the leaf of the text under `tamper` (null where it is the same)."""
    c = {x: F.col(x) for x in ("doc_id", "source", "lang", "n_chars", "text")}
    good = leaf(**c)
    bad = F.lit(None).cast("string") if tamper is None else leaf(**(c | {"text": tamper}))
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), good.alias("leaf"), bad.alias("other"))
    return rows.withColumn("other", F.nullif("other", "leaf"))


def ranked(nodes: DataFrame, *order: str, by: str = "source") -> DataFrame:
    """nodes with `rank`, their place (from 0) among those of their `by` in the given order, and `total`, the number of these: one
    sort by range, then counts of its parts; no task sees more than a part of the range, whatever a source holds."""
    # `tree` is never null and sorts as the source does, null first
    keyed = nodes.withColumn("tree", F.when(F.col(by).isNull(), "-").otherwise(F.concat(F.lit("="), by)))
    dealt = keyed.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("tree", *order, "tie").sortWithinPartitions("tree", *order, "tie")
    in_part = F.shiftleft(F.lit(1).cast("long"), 33) - 1  # below: the part's number
    at = F.monotonically_increasing_id()
    placed = common.cut(dealt.select("*", F.shiftright(at, 33).cast("int").alias("part"), at.bitwiseAND(in_part).alias("at")).drop("tie"), "ranked")
    runs = placed.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("total"))
    return placed.join(starts, ["tree", "part"]).withColumn("rank", F.col("at") + F.col("shift")).drop("part", "at", "shift")


class Block:
    """The levels of one block over its leaves; node i of level k is the bytes DIGEST * i ... of `levels[k]`."""

    def __init__(self, digests: np.ndarray, height: int | None) -> None:
        """digests: (n, 64) bytes. height: levels above the leaves; None stops at a single node."""
        self.levels = [memoryview(np.ascontiguousarray(digests)).cast("B")]
        while len(self.levels) <= height if height is not None else len(self.levels[-1]) > DIGEST:
            self.levels.append(memoryview(self._hashed(self.levels[-1])))

    @staticmethod
    def _hashed(level: memoryview) -> bytes:
        """Full runs are the rows of a reshaped matrix; what is left is a shorter one."""
        row = DIGEST * FANOUT
        full = len(level) // row
        matrix = np.frombuffer(level, np.uint8)[: full * row].reshape(full, row)
        out = [hashlib.sha256(run).hexdigest() for run in matrix]
        if len(level) > full * row:
            out.append(hashlib.sha256(level[full * row :]).hexdigest())
        return "".join(out).encode()

    @property
    def root(self) -> str:
        return bytes(self.levels[-1]).decode()

    def path(self, i: int) -> list[tuple[int, memoryview]]:
        """(place, run) on every level from leaf i to below the root."""
        out = []
        for level in self.levels[:-1]:
            first = i // FANOUT * FANOUT
            out.append((i - first, level[DIGEST * first : DIGEST * (first + FANOUT)]))
            i //= FANOUT
        return out


def proof_of(path: list[tuple[int, memoryview]]) -> str:
    """H of the siblings, level by level, left to right."""
    said = hashlib.sha256()
    for place, run in path:
        said.update(run[: DIGEST * place])
        said.update(run[DIGEST * (place + 1) :])
    return said.hexdigest()


def folded(digest: str, path: list[tuple[int, memoryview]]) -> str:
    """The root that a leaf and its siblings give."""
    for place, run in path:
        said = hashlib.sha256(run[: DIGEST * place])
        said.update(digest.encode())
        said.update(run[DIGEST * (place + 1) :])
        digest = said.hexdigest()
    return digest


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of hex digests as (n, 64) bytes."""
    return np.frombuffer("".join(column.to_pylist()).encode(), np.uint8).reshape(-1, DIGEST)


def _block(nodes: pa.Table) -> Block:
    """A block of nodes in their order; the only one of its tree ends at a single node."""
    return Block(_matrix(nodes["leaf"]), None if nodes["total"][0].as_py() <= BLOCK else HEIGHT)


def _up(nodes: pa.Table) -> pa.Table:
    """The root of a block."""
    made, blocks = _block(nodes.sort_by("rank")), -(-nodes["total"][0].as_py() // BLOCK)
    return pa.table({"tree": nodes["tree"][:1], "rank": nodes["block"][:1], "total": pa.array([blocks]), "leaf": pa.array([made.root])})


#: `top` is the digest at which the tree of the leaf ends, above which another tree may stand.
PATH = "top string, places array<int>, runs array<string>"
_PATH = {"tree": pa.string(), "block": pa.int64(), "top": pa.string(), "places": pa.list_(pa.int32()), "runs": pa.list_(pa.string())}


def _text(path: list[tuple[int, memoryview]]) -> tuple[list[int], list[str]]:
    return [p for p, _ in path], [bytes(r).decode() for _, r in path]


def _above(table: pa.Table) -> list[tuple[int, memoryview]]:
    """The path of a block's root, from the one row that brings it (none for the top)."""
    if not table.num_rows:
        return []
    return [(p, memoryview(r.encode())) for p, r in zip(table["places"][0].as_py(), table["runs"][0].as_py(), strict=True)]


def _down(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """The path to the top for each node of a block."""
    if not nodes.num_rows:
        return pa.table({c: pa.array([], t) for c, t in _PATH.items()})
    nodes = nodes.sort_by("rank")
    made, rest = _block(nodes), _text(_above(above))
    paths = [_text(made.path(i)) for i in range(nodes.num_rows)]
    return pa.table({
        "tree": nodes["tree"], "block": nodes["rank"], "top": pa.array([above["top"][0].as_py()] * nodes.num_rows, pa.string()),
        "places": pa.array([p + rest[0] for p, _ in paths], pa.list_(pa.int32())), "runs": pa.array([r + rest[1] for _, r in paths], pa.list_(pa.string())),
    })


def _blocks(nodes: DataFrame, *more: str):
    """nodes (tree, rank, total, leaf) in groups, one for each block."""
    rows = nodes.select("tree", F.floor(F.col("rank") / BLOCK).cast("long").alias("block"), "rank", "total", "leaf", *more)
    return rows.groupBy("tree", "block")


class Tree:
    """The rounds over some trees at once: `rounds[0]` are the leaves, the last one has at most a block for each tree."""

    def __init__(self, nodes: DataFrame) -> None:
        self.rounds = []
        while True:
            self.rounds.append(nodes)
            up = _blocks(nodes).applyInArrow(_up, "tree string, rank bigint, total bigint, leaf string")
            nodes = common.cut(up, "nodes")
            if not nodes.filter("total > 1").limit(1).count():
                self.roots = nodes.select("tree", "leaf")
                return

    def above(self, paths: DataFrame) -> DataFrame:
        """paths (tree and PATH) of the trees' roots to paths (tree, block, PATH) of the roots of the leaves' blocks."""
        paths = paths.withColumn("block", F.lit(0).cast("long"))
        for nodes in reversed(self.rounds[1:]):
            down = _blocks(nodes).cogroup(paths.groupBy("tree", "block")).applyInArrow(_down, f"tree string, block bigint, {PATH}")
            paths = common.cut(down, "paths")
        return paths


def _proofs(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """The proof of each leaf of a block, and the root that it or its other leaf gives."""
    if not nodes.num_rows:
        nothing = {"leaf": pa.string(), "subroot": pa.string(), "proof_sha256": pa.string(), "folded_root": pa.string()}
        return pa.table({"doc_id": pa.array([], nodes.schema.field("doc_id").type), **{c: pa.array([], t) for c, t in nothing.items()}})
    nodes = nodes.sort_by("rank")
    made, rest = _block(nodes), _above(above)
    proofs, roots = [], []
    for i, (good, bad) in enumerate(zip(nodes["leaf"].to_pylist(), nodes["other"].to_pylist(), strict=True)):
        path = made.path(i) + rest
        proofs.append(proof_of(path))
        roots.append(folded(bad or good, path))
    top = pa.array([above["top"][0].as_py()] * nodes.num_rows, pa.string())
    return pa.table({"doc_id": nodes["doc_id"], "leaf": nodes["leaf"], "subroot": top, "proof_sha256": pa.array(proofs), "folded_root": pa.array(roots)})


def manifest(docs: DataFrame, tamper: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (from the text under `tamper`, if any), verified."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, leaf string, subroot string, proof_sha256 string, folded_root string"
    rows = common.cut(ranked(leaves(docs, tamper), "doc_id", "leaf"), "leaves")
    if not rows.limit(1).count():
        return docs.sparkSession.createDataFrame([], columns.replace("folded_root", "root string, folded_root") + ", verified boolean")
    sources = Tree(rows)
    subroots = sources.roots.withColumnRenamed("tree", "name").withColumn("all", F.lit("all"))
    top = common.cut(ranked(subroots, "name", by="all"), "subroots")
    whole = Tree(top)
    root = whole.roots.first()["leaf"]
    # the path of a subroot is that of a leaf of the whole tree
    end = docs.sparkSession.createDataFrame([("=all", root, [], [])], f"tree string, {PATH}")
    paths = _blocks(top).cogroup(whole.above(end).groupBy("tree", "block")).applyInArrow(_down, f"tree string, block bigint, {PATH}")
    paths = top.join(paths.select(F.col("block").alias("rank"), "places", "runs"), "rank").select(F.col("name").alias("tree"), F.col("leaf").alias("top"), "places", "runs")
    above = sources.above(common.cut(paths, "paths"))
    out = _blocks(rows, "doc_id", "other").cogroup(above.groupBy("tree", "block")).applyInArrow(_proofs, columns)
    return out.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(docs: DataFrame) -> DataFrame:
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    return manifest(docs, F.when(hit, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text")))


def _sql() -> str:
    field = lambda c: f"case when {c} is null then '-' else octet_length(encode({c}::varchar))::varchar || ':' || {c}::varchar end"
    digest = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    # crc32 bit by bit: a byte is xor-ed in, then eight shifts (-1) follow
    bits = "flatten(list_transform(range(1, len(doc_id::varchar) + 1), lambda i: [ascii(substr(doc_id::varchar, i, 1))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "case when x >= 0 then xor(a, x) when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end"
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, {bits}), lambda a, x: {step}), 4294967295)"
    parts = [
        f"""d as (select row_number() over () as rid, doc_id, source, {digest('text')} as leaf,
            case when {crc} % {TAMPERED} = 0 then {digest(f"translate(text, '{_UPPER}', '{_LOWER}')")} else {digest('text')} end as given from documents)""",
        "a0 as (select rid, doc_id, source, leaf, row_number() over (partition by source order by doc_id nulls first, leaf, rid) - 1 as pos from d)",
        "t0 as (select source, pos, leaf as h from a0)",
    ]
    levels = 6  # 16^6 leaves in a source, 16^6 sources
    for k in range(levels):
        parts.append(
            f"t{k + 1} as (select source, pos // {FANOUT} as pos, case when any_value(n) = 1 then any_value(h) else sha256(string_agg(h, '' order by pos)) end as h "
            f"from (select *, count(*) over (partition by source) as n from t{k}) group by source, pos // {FANOUT})"
        )
    parts += [f"subs as (select source, h as subroot from t{levels})", "u0 as (select row_number() over (order by source nulls first) - 1 as pos, subroot as h, source from subs)"]
    for k in range(levels):
        parts.append(
            f"u{k + 1} as (select pos // {FANOUT} as pos, case when any_value(n) = 1 then any_value(h) else sha256(string_agg(h, '' order by pos)) end as h "
            f"from (select *, count(*) over () as n from u{k}) group by pos // {FANOUT})"
        )
    # a level counts where its tree has more than one node: place and text before and after in the run
    walk = "select rid, pos, '' as said, given as f from a0 join d using (rid)"
    parts.append(f"w0 as ({walk})")
    for k in range(levels):
        run = f"select source, pos // {FANOUT} as up, list(h order by pos) as run, any_value(n) as n from (select *, count(*) over (partition by source) as n from t{k}) group by source, pos // {FANOUT}"
        parts.append(_walk(f"w{k + 1}", f"w{k} w join d using (rid) join ({run}) r on r.up = w.pos // {FANOUT} and r.source is not distinct from d.source", "w.rid"))
    parts.append(f"v0 as (select w.rid, u0.pos, w.said, w.f from w{levels} w join d using (rid) join u0 on u0.source is not distinct from d.source)")
    for k in range(levels):
        run = f"select pos // {FANOUT} as up, list(h order by pos) as run, any_value(n) as n from (select *, count(*) over () as n from u{k}) group by pos // {FANOUT}"
        parts.append(_walk(f"v{k + 1}", f"v{k} w join ({run}) r on r.up = w.pos // {FANOUT}", "w.rid"))
    return (
        "with " + ",\n".join(parts) + f"""
select d.doc_id, d.leaf, subs.subroot, r.h as root, sha256(v.said) as proof_sha256, v.f as folded_root, v.f = r.h as verified
from d join subs on subs.source is not distinct from d.source join v{levels} v using (rid) cross join u{levels} r"""
    )


def _walk(name: str, rows: str, rid: str) -> str:
    left, right = f"array_to_string(run[:w.pos % {FANOUT}], '')", f"array_to_string(run[w.pos % {FANOUT} + 2:], '')"
    return (
        f"{name} as (select {rid} as rid, w.pos // {FANOUT} as pos, case when n = 1 then said else said || {left} || {right} end as said, "
        f"case when n = 1 then f else sha256({left} || f || {right}) end as f from {rows})"
    )


SQL = _sql()
