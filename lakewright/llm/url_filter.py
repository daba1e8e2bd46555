"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from labelled URLs: distinct URLs that a rule decides carry the rule's verdict. A bounded sample is
taken (`PER_CLASS` URLs of either class, in the order of a hash). Features: lengths of host, path and query, depth,
digit ratio, entropy, parameter counts, hyphens, and smoothed block rates of the host's suffixes and words.
The rates must not give the rules themselves away: no rule's host and no suffix of one (`com`, `example.com`) has a
rate, nor has a word in one, and a training URL takes its rates from the other `FOLDS` - 1 parts of the sample (parts by
a hash of the host without its rule), while other URLs take them from all of it.

The trees have a say only as far as they know something: each part is judged by trees of the other parts, with the threshold that
gives these the best balanced accuracy (the mean of the shares found of either class, 0.5 for a constant answer). Where the parts
reach less than `SKILL` together, no URL without a rule is blocked. Where parts cannot tell (one class in a part's training
or in what is judged), the trees decide at 0.5.

Defined results: a null URL or one without `://` has an empty host and path, and is judged by the trees on
empty text; a host or path is not trimmed or decoded; of several fitting rules the longest (host and path)
wins, of equally long ones the later one; repeated rows are judged alike; other columns are not read; without labelled URLs all are allowed.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm import common, trees

#: (verdict, host, path) of each rule.
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
PER_CLASS = 20_000
FOLDS = 5
#: Balanced accuracy that the trees must have on sites that they have not seen, or they do not decide.
SKILL = 0.65
_WORDS = re.compile(r"[a-z]+")


def parts(pages: DataFrame) -> DataFrame:
    """(page_id, host, path, rest) of each row's `url`; rest is what follows the path."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    lower = F.translate(F.regexp_extract(after, r"(?s)^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        lower.alias("host"),
        F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"),
        F.regexp_extract(after, r"(?s)^[^?#]*(.*)$", 1).alias("rest"),
    )


def ruled(df: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Adds `rule` and `said`: the longest fitting rule and its verdict, else null."""
    text, said = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        text = F.when(fits, F.lit(host + path)).otherwise(text)
        said = F.when(fits, F.lit(verdict)).otherwise(said)
    return df.withColumns({"rule": text, "said": said})


class Lexical:
    """Features of (host, path, rest); the rates come from the training URLs."""

    def __init__(self, hosts: list[str], block: np.ndarray, rules: list[tuple[str, str, str]] = RULES) -> None:
        ends = [".".join(labels[k:]) for labels in (host.split(".") for _, host, _ in rules) for k in range(len(labels))]
        self.told = set(ends) | {"w:" + w for x in ends for w in _WORDS.findall(x)}
        self.labels = {x for end in ends for x in end.split(".")}
        self.prior = (float(block.sum()) + 1) / (len(block) + 2)
        self.fold = np.array([self.fold_of(h) for h in hosts], int)
        self.counted = [self._count(hosts, block, self.fold != k) for k in range(FOLDS)] + [self._count(hosts, block, np.ones(len(hosts), bool))]

    def fold_of(self, host: str) -> int:
        """All URLs of a name under the rules' hosts are in one part, so that a rate never comes from the URL's own site."""
        own = [x for x in host.split(".") if x not in self.labels]
        return xxhash.xxh64_intdigest(own[-1] if own else host) % FOLDS

    def _count(self, hosts: list[str], block: np.ndarray, use: np.ndarray) -> dict[str, float]:
        total, bad = Counter(), Counter()
        for k in np.flatnonzero(use):
            for key in self.keys(hosts[k]):
                total[key] += 1
                bad[key] += block[k]
        return {key: (bad[key] + 10 * self.prior) / (n + 10) for key, n in total.items() if n >= 5}

    def keys(self, host: str) -> list[str]:
        """The host's suffixes (up to three labels) and words that no rule tells."""
        labels = host.split(".")
        found = [".".join(labels[-k:]) for k in range(1, min(4, len(labels) + 1))] + sorted("w:" + w for w in set(_WORDS.findall(host)))
        return [x for x in found if x not in self.told]

    def row(self, host: str, path: str, rest: str, rates: dict[str, float] | None = None) -> list[float]:
        known = self.counted[FOLDS] if rates is None else rates
        url = host + path + rest
        n = max(1, len(url))
        times = Counter(url)
        entropy = -sum(c / n * math.log2(c / n) for c in times.values()) if url else 0.0
        keys = self.keys(host)
        ends = [known.get(k, self.prior) for k in keys if k[:2] != "w:"] or [self.prior]
        words = [known.get(k, self.prior) for k in keys if k[:2] == "w:"] or [self.prior]
        return [
            len(host), len(path), len(rest), host.count("."), path.count("/"),
            sum(c.isdigit() for c in url) / n, sum(c.isdigit() for c in host), entropy,
            rest.count("=") + 0.0, rest.count("&") + 0.0, float("#" in rest), host.count("-") + 0.0,
            float(path.endswith("/")), float("." in path.rsplit("/", 1)[-1]), ends[0], ends[-1], max(words), min(words), sum(words) / len(words),
        ]

    def matrix(self, hosts, paths, rests, folds=None) -> np.ndarray:
        folds = [FOLDS] * len(hosts) if folds is None else folds
        rows = [self.row(h, p, r, self.counted[k]) for h, p, r, k in zip(hosts, paths, rests, folds, strict=True)]
        return np.array(rows, float) if rows else np.zeros((0, 19))


def best_cut(score: np.ndarray, block: np.ndarray) -> float:
    """The threshold of the best balanced accuracy; 0.5 where there is one class only or no difference."""
    if not 0 < block.sum() < len(block):
        return 0.5
    order = np.argsort(score, kind="stable")
    s, y = score[order], block[order]
    gain = np.cumsum(1 - y) / (1 - y).sum() - np.cumsum(y) / y.sum()  # of blocking what lies above
    gain[:-1][s[:-1] == s[1:]] = -1  # equal scores are not parted
    at = int(gain[:-1].argmax())
    return float((s[at] + s[at + 1]) / 2) if gain[at] > 0 else 0.5


def measured(x: np.ndarray, block: np.ndarray, fold: np.ndarray) -> tuple[float, float | None]:
    """(threshold, balanced accuracy on parts that the trees have not learnt from; None where the parts cannot tell)."""
    score = np.full(len(block), np.nan)
    for k in range(FOLDS):
        own = fold == k
        if own.any() and 0 < block[~own].sum() < (~own).sum():
            score[own] = trees.fit(x[~own], block[~own]).score(x[own])
    seen = ~np.isnan(score)
    score, block, fold = score[seen], block[seen], fold[seen]
    if not 0 < block.sum() < len(block):
        return 0.5, None
    said = np.zeros(len(block), bool)
    for k in range(FOLDS):  # the threshold comes from the other parts, too
        own = fold == k
        said[own] = score[own] > best_cut(score[~own], block[~own])
    return best_cut(score, block), float((said[block == 1].mean() + (~said[block == 0]).mean()) / 2)


@dataclass
class Model:
    lexical: Lexical
    trees: trees.FlatTrees
    threshold: float
    #: Balanced accuracy on unseen sites; None where it cannot be told.
    skill: float | None

    def blocks(self, score: float) -> bool:
        return (self.skill is None or self.skill >= SKILL) and score > self.threshold


def train(df: DataFrame, per_class: int = PER_CLASS, rules: list[tuple[str, str, str]] = RULES) -> Model:
    """From the URLs of df (with `said`) that a rule decides."""
    own = df.filter("said is not null").select("host", "path", "rest", "said").distinct()
    own = own.withColumn("place", F.xxhash64("host", "path", "rest"))
    rows = [r for v in ("allow", "block") for r in own.filter(F.col("said") == v).orderBy("place", "host", "path", "rest").limit(per_class).collect()]
    block = np.array([r["said"] == "block" for r in rows], float)
    lexical = Lexical([r["host"] for r in rows], block, rules)
    x = lexical.matrix(*[[r[c] for r in rows] for c in ("host", "path", "rest")], lexical.fold)
    return Model(lexical, trees.fit(x, block), *measured(x, block, lexical.fold))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, fold_accuracy) for each row; score is the trees' chance of block,
    fold_accuracy their balanced accuracy on sites that they have not seen."""
    df = ruled(parts(pages), rules)
    sent = df.sparkSession.sparkContext.broadcast(train(df, rules=rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            s = model.trees.score(model.lexical.matrix(*[batch.column(c).to_pylist() for c in ("host", "path", "rest")]))
            said = [x or ("block" if model.blocks(p) else "allow") for x, p in zip(batch.column("said").to_pylist(), s.tolist(), strict=True)]
            known = {c: batch.column(c) for c in ("page_id", "host", "path", "rule")}
            skill = pa.array([model.skill] * len(said), pa.float64())
            yield common.batch_of(**known, verdict=pa.array(said, pa.string()), score=pa.array(s, pa.float64()), fold_accuracy=skill)

    return df.mapInArrow(common.released(run), "page_id bigint, host string, path string, rule string, verdict string, score double, fold_accuracy double")


def query(pages: DataFrame) -> DataFrame:
    return judge(pages)
