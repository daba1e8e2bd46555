"""Personal data: fixed detectors for e-mail, IP, card and phone, then bootstrapped contextual extraction.

Bootstrapping finds identifiers that no detector knows by the words around them:
  1. Seeds are the detectors' matches and credential-like tokens (mixed hexadecimal of 16 or more characters,
     capital keys of 20). Every identifier-like token (6 or more characters with a digit) is an instance, in the
     graph by a hash from `LONG` characters on.
  2. Each instance has up to two lexical patterns: what stands before it (`word=`, `word:` or the token before)
     and its own first four letters.
  3. A pattern's total is the number of all fillers in the corpus, ordinary words included, counted over all
     documents, so that a pattern such as "the" has next to no confidence.
  4. Spark scores the bipartite graph of patterns and instances for `ROUNDS` rounds: a pattern's confidence is the
     share of its fillers' score in its total; an instance's score is the noisy-or of its patterns.
  5. Instances after a pattern of at least `CONFIDENCE` and `SUPPORT` distinct seeds become spans of the kind that
     most of the pattern's seeds have (credential seeds: `secret`), where no base span stands already.

Defined results: null texts are empty and have no spans; repeated rows get the same spans (each row counts
in the statistics); offsets are code points, end exclusive; without seeds only base spans remain; other
columns are kept by `stage` and not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm import common

KINDS = ("email", "ip", "card", "phone", "secret")
ROUNDS, CONFIDENCE, SUPPORT = 3, 0.6, 5
#: Instances of more characters are named by a hash in the graph.
LONG = 128
#: Accepted or counted patterns in one broadcast at most; beyond, accepted ones are taken in several passes, one broadcast
#: at a time, and the fillers of all patterns are counted in one pass by a shuffle.
PATTERNS = 200_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never ends inside a run of digits, and starting later inside one cannot help
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"""[^\s"'<>()\[\]{},;|=:]{6,}""")
_HEX = re.compile(r"(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{16,}\Z")
_KEY = re.compile(r"(?=[A-Z0-9]*[0-9])[A-Z]{3}[A-Z0-9]{17}\Z")
_ASSIGN = re.compile(r"""([^\W\d_]{2,20})\s{0,3}([=:])\s{0,3}["']?(?=[^\s"'=:])""")
_ASSIGN_BEFORE = re.compile(r"""([^\W\d_]{2,20})\s{0,3}([=:])\s{0,3}["']?\Z""")
_LETTERS = re.compile(r"[A-Za-z]{4}")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if k % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        got = _DOMAIN.match(text, at + 1) if start < at else None
        if got:
            yield start, got.end(), "email"
            last = got.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[Span]:
    """The detectors' spans by start, then kind."""
    out: list[Span] = []
    if "@" in text:
        out += _emails(text)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m[0].split(".")):
                out.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=order)


def order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def patterns_at(text: str, start: int, token: str) -> list[str]:
    """The lexical patterns of an instance."""
    left = text[max(0, start - 32) : start]
    if m := _ASSIGN_BEFORE.search(left):
        out = [m[1].lower() + m[2]]
    else:
        before = left.split()
        out = [before[-1].lower() + " "] if before and left[-1:].isspace() and (len(before) > 1 or start < 32) and len(before[-1]) <= 20 else []
    if _LETTERS.match(token):
        out.append("^" + token[:4].lower())
    return out


def tokens(text: str, spans: list[Span]) -> Iterator[tuple[int, int, str]]:
    """(start, end, token) of each identifier-like token that meets none of spans (by start)."""
    walk = iter(_merged(spans))
    low, high = next(walk, (len(text), len(text)))
    for m in _TOKEN.finditer(text):
        token = m[0].rstrip(".!?%&*$#")
        if len(token) < 6 or not _DIGIT.search(token):
            continue
        a, b = m.start(), m.start() + len(token)
        while high <= a and low < len(text):
            low, high = next(walk, (len(text), len(text)))
        if b <= low:
            yield a, b, token


def _merged(spans: list[Span]) -> Iterator[tuple[int, int]]:
    """What spans (by start) cover, as runs that do not meet."""
    low = high = None
    for a, b, _ in spans:
        if low is None or a > high:
            if low is not None:
                yield low, high
            low, high = a, b
        else:
            high = max(high, b)
    if low is not None:
        yield low, high


def instances(text: str, spans: list[Span]) -> Iterator[tuple[str, str | None, list[str]]]:
    """(token, seed kind, patterns) of each base span and identifier-like token."""
    for a, b, kind in spans:
        yield text[a:b], kind, patterns_at(text, a, text[a:b])
    for a, _, token in tokens(text, spans):
        yield token, "secret" if _HEX.match(token) or _KEY.match(token) else None, patterns_at(text, a, token)


def name_of(token: str) -> str:
    """The instance in the graph; no token starts with a blank."""
    return token if len(token) <= LONG else " " + xxhash.xxh3_128_hexdigest(token.encode("utf-8", "replace"))


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter = Counter()
        for text in batch.column("body").to_pylist():
            if text and ("@" in text or _DIGIT.search(text)):
                for token, kind, keys in instances(text, base_spans(text)):
                    name = name_of(token)
                    for key in keys:
                        found[key, name, kind] += 1
        keys = list(found)
        yield common.batch_of(
            pattern=_strings(k for k, _, _ in keys), instance=_strings(k for _, k, _ in keys), kind=_strings(k for _, _, k in keys), n=pa.array(list(found.values()), pa.int64())
        )


def _strings(values) -> pa.Array:
    return pa.array(list(values), pa.string())


class _Short:
    """Whatever may be a pattern: 20 characters and a mark, of which a lower-cased one may be two."""

    def __contains__(self, x: str) -> bool:
        return len(x) <= 41


class _Heads:
    """First letters that a pattern may have."""

    def __contains__(self, x: str) -> bool:
        return _LETTERS.fullmatch(x) is not None


def _totals(sent=None):
    """Fillers of the patterns that were sent, or of whatever may be one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _Short() if sent is None else sent.value
        heads = _Heads() if sent is None else {p[1:] for p in wanted if p[0] == "^"}
        for batch in batches:
            words, out = Counter(), Counter()
            for text in batch.column("body").to_pylist():
                if not text:
                    continue
                words.update(text.lower().split())
                if "=" in text or ":" in text:
                    for a, b in _ASSIGN.findall(text):
                        out[a.lower() + b] += 1
            rows = Counter({k: n for k, n in out.items() if k in wanted})
            for word, n in words.items():
                if word + " " in wanted:
                    rows[word + " "] += n
                if word[:4] in heads:
                    rows["^" + word[:4]] += n
            yield common.batch_of(pattern=_strings(rows), n=pa.array(list(rows.values()), pa.int64()))

    return run


def learn(docs: DataFrame, text: str = "text") -> DataFrame:
    """(pattern, kind, confidence, support) of the accepted patterns."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text).cast("string").alias("body"))
    edges = common.cut(
        rows.mapInArrow(common.released(_edges), "pattern string, instance string, kind string, n bigint").groupBy("pattern", "instance", "kind").agg(F.sum("n").alias("n")), "edges"
    )
    support = edges.filter("kind is not null").groupBy("pattern", "kind").agg(F.count("*").alias("s"))
    support = support.groupBy("pattern").agg(F.sum("s").alias("support"), F.max(F.struct("s", "kind"))["kind"].alias("kind")).filter(F.col("support") >= SUPPORT)
    support = common.cut(support, "support")
    few = support.count() <= PATTERNS
    sent = spark.sparkContext.broadcast(frozenset(r["pattern"] for r in support.select("pattern").collect())) if few else None
    totals = rows.mapInArrow(common.released(_totals(sent)), "pattern string, n bigint").groupBy("pattern").agg(F.sum("n").alias("total"))
    known = common.cut(support.join(totals, "pattern"), "totals")
    graph = common.cut(
        edges.withColumn("seed", F.col("kind").isNotNull()).drop("kind").join(known.select("pattern", "total"), "pattern"), "graph"
    )
    common.forget(edges, support)
    scores = confidence = None
    for _ in range(ROUNDS):
        scored = graph.withColumn("score", F.col("seed").cast("double")) if scores is None else graph.join(scores, "instance", "left").withColumn(
            "score", F.when(F.col("seed"), F.lit(1.0)).otherwise(F.coalesce("near", F.lit(0.0)))
        )
        before = confidence
        confidence = common.cut(scored.groupBy("pattern").agg((F.sum(F.col("n") * F.col("score")) / F.greatest(F.max("total"), F.sum("n"))).alias("confidence")), "confidence")
        if before is not None:
            common.forget(before)
        near = graph.filter("not seed").join(confidence, "pattern").groupBy("instance")
        scores = near.agg((1 - F.exp(F.sum(F.log(1 - F.least(F.lit(0.99), F.col("confidence")))))).alias("near"))
    accepted = known.join(confidence, "pattern").filter(F.col("confidence") >= CONFIDENCE)
    out = common.cut(accepted.select("pattern", "kind", "confidence", "support"), "accepted")
    common.forget(graph, known, confidence)
    return out


FOUND = "base array<string>, spans array<string>"


def find(docs: DataFrame, text: str = "text", patterns: DataFrame | None = None, masked: bool = False) -> DataFrame:
    """docs as common.apart() has them, with `base` and `spans`: strings kind:start:end, by start, then kind.

    masked: with `changed` instead of these, and the masked text as `body` (in the last pass's Python worker).
    """
    patterns = learn(docs, text) if patterns is None else patterns
    plain, parts = common.apart(docs, text), max(1, -(-patterns.count() // PATTERNS))
    dealt = [F.lit(True)]
    if parts > 1:  # what stands before a token comes before the token's own letters, as in patterns_at()
        dealt = [(F.col("pattern").startswith("^") == own) & (F.pmod(F.xxhash64("pattern"), F.lit(parts)) == k) for own in (False, True) for k in range(parts)]

    def part(k: int) -> dict[str, str]:
        return {r["pattern"]: r["kind"] for r in patterns.filter(dealt[k]).select("pattern", "kind").collect()}

    def search(df: DataFrame, sent, last: bool) -> DataFrame:
        schema = common.wider(plain, "changed boolean" if masked and last else FOUND)
        return df.mapInArrow(common.released(_finder(sent, masked and last)), schema)

    return common.in_passes(plain, len(dealt), part, search)


def _written(spans: list[Span]) -> list[str]:
    return [f"{kind}:{a}:{b}" for a, b, kind in spans]


def parse_spans(spans) -> list[Span]:
    return [(int(a), int(b), kind) for kind, a, b in (x.split(":") for x in spans)]


def _finder(sent, masked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accepted = sent.value
        for batch in batches:
            bodies, bases, alls = batch.column("body").to_pylist(), [], []
            before = batch.column("spans").to_pylist() if "spans" in batch.schema.names else [()] * len(bodies)
            for body, old in zip(bodies, before, strict=True):
                base = base_spans(body) if body else []
                more, old = [], parse_spans(old)
                known = {(a, b) for a, b, _ in old}
                if body and accepted and _DIGIT.search(body):
                    for a, b, token in tokens(body, base):
                        kind = next((accepted[p] for p in patterns_at(body, a, token) if p in accepted), None)
                        if kind and (a, b) not in known:
                            more.append((a, b, kind))
                bases.append(base)
                alls.append(sorted({*base, *more, *old}, key=order) if more or old else base)
            if masked:
                texts = [mask(t, spans) for t, spans in zip(bodies, alls, strict=True)]
                yield common.batch_of(row=batch.column("row"), body=_strings(texts), changed=pa.array([bool(x) for x in alls], pa.bool_()))
            else:
                lists = [pa.array([_written(x) for x in y], pa.list_(pa.string())) for y in (bases, alls)]
                yield common.batch_of(row=batch.column("row"), body=batch.column("body"), base=lists[0], spans=lists[1])

    return run


def mask(body: str | None, spans: list[Span]) -> str | None:
    """Spans become [KIND]; of overlapping ones the first stands for all."""
    if not body or not spans:
        return body
    out, last = [], 0
    for a, b, kind in sorted(spans, key=order):
        if a >= last:
            out += [body[last:a], f"[{kind.upper()}]"]
        last = max(last, b)
    return "".join([*out, body[last:]])


def stage(docs: DataFrame) -> DataFrame:
    """The documents with their personal data masked; all stay."""
    return common.together(find(docs, masked=True), docs)


def query(docs: DataFrame) -> DataFrame:
    found = find(docs.select("doc_id", "text"))
    kind = lambda k: F.size(F.filter("base", lambda x: x.startswith(k + ":"))).cast("long").alias(f"n_{k}")
    return found.select(
        "row.doc_id", *[kind(k) for k in KINDS[:4]], F.sha2(F.array_join("base", ","), 256).alias("base_sha256"), F.array_join("spans", ",").alias("spans")
    )


def sha256_of(spans: list[str]) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()
