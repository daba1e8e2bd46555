"""Aspect sentiment (N01-N09): keyword spans, context, negation, adverbs, score, category.

The span search and the contexts run in one Arrow UDF; all that follows are column expressions over its spans. Terms of equal length are
taken in code-point order.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lakewright.config import lexicons
from lakewright.functions import keywords, vectors

WINDOW = 3
MOST = 20
#: Rows of an Arrow batch whose texts and spans are Python objects at a time.
ROWS = 64
_SPANS = pa.list_(pa.struct([("keyword", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("context", pa.string())]))


def keyword_spans(c: Column, sentiment: dict[str, float] | None = None, categories: dict[str, tuple[str, ...]] | None = None, nouns=None) -> Column:
    """Array of (keyword, start, end, context), 0-based. `nouns`: optional callable text -> list of nouns. The
    context is that of N03; it is found here, since the text is split once for all of its keywords."""
    sentiment = lexicons.SENTIMENT if sentiment is None else sentiment
    categories = lexicons.CATEGORY_TERMS if categories is None else categories
    known = {*sentiment, *(t for x in categories.values() for t in x)}
    lexicon = keywords.Finder(keywords.ordered(known))

    @arrow_udf("array<struct<keyword:string,start:int,end:int,context:string>>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return span_batches(texts, find)

    def find(text: str) -> list[tuple[str, int, int]]:
        if nouns is not None:
            try:
                got = nouns(text)
                inside = [x for x in got if x in known]
                rest = [x for x in got if len(x) >= 2 and x not in known]
                chosen = list(dict.fromkeys(inside + rest))[:MOST]
                if out := [(x, text.index(x), text.index(x) + len(x)) for x in chosen if x in text]:
                    return out
            except Exception:  # noqa: BLE001  a tagger that fails leaves the lexicon
                pass
        return lexicon.spans(text, MOST)

    return run(c)


def span_batches(texts: Iterator[pa.Array], find: Callable[[str], list[tuple[str, int, int]]]) -> Iterator[pa.Array]:
    """The spans of `ROWS` texts after the other: what a worker holds beside a batch of texts does not grow with the batch."""
    for batch in texts:
        for k in range(0, len(batch), ROWS):
            found = (x if x is None else in_context(x, find(x)) for x in batch.slice(k, ROWS).to_pylist())
            yield pa.array([x if x is None else [dict(zip(("keyword", "start", "end", "context"), y, strict=True)) for y in x] for x in found], _SPANS)


def in_context(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int, str]]:
    """Spans with their N03 contexts: the text's tokens and where they end, single spaces between, are found once."""
    if not spans:
        return []
    tokens = _TOKEN.findall(text)
    ends = list(accumulate(len(t) + 1 for t in tokens))
    out = []
    for word, start, end in spans:
        k = bisect_right(ends, start)
        held = k < len(tokens) and start < ends[k] - 1  # else it is a space between two
        out.append((word, start, end, " ".join(tokens[max(0, k - WINDOW) : k + WINDOW + 1]) if held else text))
    return out


#: White space of the Unicode standard, as in the column expressions.
_TOKEN = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def local_context(text: Column, start: Column) -> Column:
    """The token around `start` and three on either side; the text where no token holds it."""
    tokens = F.filter(F.split(text, r"(?U)\s+"), lambda t: t != "")
    # places of tokens when single spaces stand between them
    place = F.aggregate(
        tokens,
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"), F.lit(-1).alias("hit")),
        lambda a, t: F.struct(
            (a["at"] + F.length(t) + 1).alias("at"),
            (a["n"] + 1).alias("n"),
            F.when((a["hit"] < 0) & (a["at"] <= start) & (start < a["at"] + F.length(t)), a["n"]).otherwise(a["hit"]).alias("hit"),
        ),
        lambda a: a["hit"],
    )
    around = F.array_join(F.slice(tokens, F.greatest(place - WINDOW, F.lit(0)) + 1, F.least(place, F.lit(WINDOW)) + 1 + WINDOW), " ")
    return F.when(place < 0, text).otherwise(around)


def has_negation(text: Column, keyword: Column | None = None, negations: tuple[str, ...] = lexicons.NEGATIONS) -> Column:
    """A token is a negation, or starts with a negation and the keyword."""
    words = F.array(*map(F.lit, negations))
    tokens = F.split(text, r"(?U)\s+")

    def hit(t: Column) -> Column:
        out = F.array_contains(words, t)
        return out | F.exists(words, lambda n: t.startswith(F.concat(n, keyword))) if keyword is not None else out

    return F.exists(tokens, hit)


def adverb_weight(text: Column, adverbs: dict[str, float] | None = None) -> Column:
    """Of the adverbs in the text the weight furthest from 1, the first of equals; else 1."""
    out = F.lit(1.0)
    for word, weight in (lexicons.ADVERBS if adverbs is None else adverbs).items():
        out = F.when(text.contains(word) & (F.lit(abs(weight - 1.0)) > F.abs(out - 1.0)), F.lit(float(weight))).otherwise(out)
    return out


def _lookup(c: Column, table: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[c] if table else F.lit(None).cast("double")


def score(base: Column, weight: Column, negated: Column) -> Column:
    """N06."""
    raw = base * weight
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(negated, 1.0 - raw).otherwise(raw))), 4)


def category(keyword: Column, categories: dict[str, tuple[str, ...]] | None = None) -> Column:
    """The first category with a term that is a prefix of the keyword or the other way round. Both are looked up among all
    terms at once (Spark hashes the lists): the keyword's beginnings of each length that terms have, and the keyword among the terms' own beginnings."""
    out = F.lit(None).cast("string")
    for name, terms in reversed((lexicons.CATEGORY_TERMS if categories is None else categories).items()):
        fits = keyword.isin(sorted({t[:n] for t in terms for n in range(len(t) + 1)}))
        for n in sorted({len(t) for t in terms}):
            fits = fits | F.substring(keyword, 1, n).isin(sorted({t for t in terms if len(t) == n}))
        out = F.when(fits, F.lit(name)).otherwise(out)
    return out


def analyze(
    reviews: DataFrame, text: str = "refined_text", sentiment: dict[str, float] | None = None, adverbs: dict[str, float] | None = None,
    negations: tuple[str, ...] = lexicons.NEGATIONS, categories: dict[str, tuple[str, ...]] | None = None, nouns=None,
    embeddings: DataFrame | None = None, anchors: dict[str, list[float]] | None = None, threshold: float = 0.8,
) -> DataFrame:
    """(review_id, keyword, sentiment_score, category); a review without keywords has no row (a failure).

    With embeddings (review_id, vector) and anchors, a keyword without a category by rule gets that of the anchor nearest
    to its review's vector (N08), if that reaches the threshold.
    """
    sentiment = lexicons.SENTIMENT if sentiment is None else sentiment
    rows = reviews.select("review_id", F.explode(keyword_spans(F.col(text), sentiment, categories, nouns)).alias("s")).select("review_id", "s.keyword", "s.context")
    base = F.coalesce(_lookup(F.col("keyword"), sentiment), F.lit(0.5))
    out = rows.select(
        "review_id",
        "keyword",
        score(base, adverb_weight(F.col("context"), adverbs), has_negation(F.col("context"), F.col("keyword"), negations)).alias("sentiment_score"),
        category(F.col("keyword"), categories).alias("category"),
    )
    if embeddings is None or not anchors:
        return out
    near = embeddings.select("review_id", vectors.nearest_anchor(embeddings, anchors, "vector", threshold).alias("near")).filter("near is not null")
    return out.join(near, "review_id", "left").withColumn("category", F.coalesce("category", "near")).drop("near")
