"""Quality classifier: histogram gradient-boosted trees over document statistics, flattened into arrays and
walked with numpy over whole Arrow batches.

Learnt from a bounded sample (`PER_CLASS` labelled documents of either class, see labelled.sample); labels,
language, source and ids are no inputs. Score: estimated chance of label 1.

Defined results: null texts count as empty and get a score like any other; without usable labels every
score is 0.5; repeated rows score alike; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakewright.llm import common, labelled, trees

PER_CLASS = 4000
MOD, OUT = 4, 2
THRESHOLD = 0.7
_CAPS = re.compile(r"[A-Z]")
_LOW = re.compile(r"[a-z]")
_DIGIT = re.compile(r"[0-9]")


def statistics(text: str | None) -> list[float]:
    """What the trees see of one whole text."""
    text = text or ""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    per_word = 1 / max(1, n)
    lines = [x for x in text.split("\n") if x.strip()]
    different = len(set(words))
    same_next = sum(map(str.__eq__, words, words[1:]))
    seven = set(zip(words, words[1:], words[2:], words[3:], strict=False)) if n > 3 else ()
    caps, low = len(_CAPS.findall(text)), len(_LOW.findall(text)) if n else 0
    ends = sum(text.count(x) for x in ".:;?")
    return [
        float(np.log1p(n)),
        chars * per_word,
        different * per_word,
        same_next * per_word,
        len(seven) / max(1, n - 3) if n > 3 else 1.0,
        caps / max(1, caps + low),
        sum(text.count(x) for x in "#*$%&<>") * per_word,
        text.count("|") * per_word,
        text.count("!") * per_word,
        ends * per_word,
        text.count(",") * per_word,
        len(_DIGIT.findall(text)) / chars,
        len(set(lines)) / max(1, len(lines)) if lines else 1.0,
        n / max(1, len(lines)),
        float(max(map(len, words), default=0)),
    ]


def matrix(texts) -> np.ndarray:
    rows = [statistics(t) for t in texts]
    return np.array(rows, float).reshape(len(rows), -1) if rows else np.zeros((0, 1))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> trees.FlatTrees:
    rows = labelled.sample(docs, labels, "quality", MOD, OUT, per_class)
    y = rows["label"].to_numpy(float)
    return trees.fit(matrix(rows["text"]), y) if len(rows) else trees.fit(np.zeros((0, 1)), np.zeros(0))


def score(docs: DataFrame, model: trees.FlatTrees) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield labelled.scored(batch, sent.value.score(matrix(batch.column("body").to_pylist())), THRESHOLD)

    return labelled.scoring_rows(docs, MOD, OUT).mapInArrow(common.released(run), labelled.SCORED)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
