import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakewright.functions import actions, aspects, remote, vectors
from lakewright.functions.keywords import Finder, ordered, spans

GOLDEN = {
    "편리한 앱입니다": {"편리": 0.85},
    "매우 편리한 앱입니다": {"편리": 1.0},
    "좀 편리한 앱입니다": {"편리": 0.68},
    "안 편리한 앱입니다": {"편리": 0.15},
    "안좋음": {"좋": 0.20},
    "안녕하세요 반갑습니다": {},
}


def test_scores(spark):
    rows = spark.createDataFrame([(t, t) for t in GOLDEN], "review_id string, refined_text string")
    got = {t: {} for t in GOLDEN}
    for r in aspects.analyze(rows).collect():
        got[r["review_id"]][r["keyword"]] = r["sentiment_score"]
    assert got == GOLDEN


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("편리한 앱인데 그냥 쓰기 좋고 오류는 안 나요", {"편리": 0.85, "오류": 0.90}),
        ("매우 편리한 기능들 좋고 그런데 오류가 있어요", {"편리": 1.0, "오류": 0.10}),
    ],
)
def test_context_of_each_keyword(spark, text, expected):
    rows = aspects.analyze(spark.createDataFrame([("r", text)], "review_id string, refined_text string")).collect()
    got = {r["keyword"]: r["sentiment_score"] for r in rows}
    assert expected.items() <= got.items()


def test_spans():
    assert [k for k, _, _ in spans("편리 편리 편리", ordered(["편리"]))] == ["편리"]
    assert spans("불안정한 안정", ordered(["안정", "불안정"])) == [("불안정", 0, 3), ("안정", 5, 7)]
    many = [f"w{i:02d}" for i in range(30)]
    assert len(spans(" ".join(many), ordered(many))) == 20


def test_negation_adverb_category(spark):
    df = spark.createDataFrame([("안 돼요",), ("못 써요",), ("잘 돼요",), ("앱이 안정적이고 빠릅니다",)], "t string")
    assert [r[0] for r in df.select(aspects.has_negation(F.col("t"))).collect()] == [True, True, False, False]
    df = spark.createDataFrame([("매우 좋다",), ("극도로",), ("매우 극도로",), ("없음",)], "t string")
    assert [r[0] for r in df.select(aspects.adverb_weight(F.col("t"))).collect()] == [1.3, 1.4, 1.4, 1.0]
    df = spark.createDataFrame([("편리",), ("오류",), ("속도",), ("디자인",), ("zzz",)], "t string")
    assert [r[0] for r in df.select(aspects.category(F.col("t"))).collect()] == ["USABILITY", "STABILITY", "SPEED", "DESIGN", None]


def test_noun_tagger(spark):
    df = spark.createDataFrame([("앱 속도 화면",)], "t string")
    got = df.select(aspects.keyword_spans(F.col("t"), nouns=lambda t: ["앱", "화면", "가나", "속도"]).alias("s")).first()["s"]
    assert [x["keyword"] for x in got] == ["화면", "속도"]

    def broken(t):
        raise RuntimeError

    assert [x["keyword"] for x in df.select(aspects.keyword_spans(F.col("t"), nouns=broken).alias("s")).first()["s"]] == ["속도", "화면"]


def test_votes(spark):
    rows = [("안녕하세요", 3), ("버그가 있어요", 3), ("잘 쓰고 있어요", 1), ("버그 고쳐줘", 2), ("개선해주세요", 4)]
    df = spark.createDataFrame(rows, "t string, r int")
    got = [tuple(r["v"]) for r in df.select(actions.vote(actions.fired(F.col("t"), F.col("r"))).alias("v")).collect()]
    assert got == [
        (False, 0.5, None), (True, 1.0, "LF_bug_keyword"), (True, 1.0, "LF_low_rating"),
        (True, 1.0, "LF_bug_keyword, LF_request_keyword, LF_low_rating"), (True, 1.0, "LF_request_keyword"),
    ]


def test_attention(spark):
    df = spark.createDataFrame([(5, 0.2), (1, 0.9), (5, 0.8), (1, 0.1), (4, 0.4), (2, 0.6)], "r int, s double")
    assert [r[0] for r in df.select(actions.attention(F.col("r"), F.col("s"))).collect()] == [True, True, False, False, False, False]


def test_cosine_and_anchor(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 1.0]), ([1.0, 0.0], [-1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    assert [r[0] for r in df.select(vectors.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, -1.0, 0.0]
    df = spark.createDataFrame([([0.9, 0.1],), ([0.6, 0.6],), ([-1.0, 0.0],)], "vector array<float>")
    anchors = {"X": [1.0, 0.0], "Y": [1.0, 0.0]}
    assert [r[0] for r in df.select(vectors.nearest_anchor(df, anchors)).collect()] == ["X", None, None]
    with pytest.raises(ValueError):
        vectors.model_dimension("no-such-model")


def test_embed(spark):
    rows = spark.createDataFrame([("a", "some text"), ("b", " "), ("c", None)], "review_id string, refined_text string")
    assert [r["review_id"] for r in vectors.embed(rows, vectors.hashing_embedder()).collect()] == ["a"]
    assert vectors.embed(rows, vectors.hashing_embedder(8)).count() == 0


def test_anchors_are_data(spark, tmp_path):
    (tmp_path / "anchors.json").write_text('{"USABILITY": [1, 0], "SPEED": [0, 1]}')
    assert vectors.read_anchors(spark, f"file://{tmp_path}/anchors.json", 2) == {"USABILITY": [1, 0], "SPEED": [0, 1]}
    with pytest.raises(ValueError):
        vectors.read_anchors(spark, f"file://{tmp_path}/anchors.json", 3)


def test_category_falls_back_to_the_nearest_anchor(spark):
    reviews = spark.createDataFrame([("a", "xyz"), ("b", "xyz"), ("c", "xyz"), ("d", "app")], "review_id string, refined_text string")
    known = spark.createDataFrame([("a", [1.0, 0.1]), ("b", [0.7, 0.7]), ("d", [0.0, 1.0])], "review_id string, vector array<float>")
    got = aspects.analyze(reviews, sentiment={"xyz": 0.9, "app": 0.5}, categories={"DESIGN": ("app",)}, embeddings=known, anchors={"SPEED": [1.0, 0.0], "USABILITY": [0.0, 1.0]})
    assert {r["review_id"]: r["category"] for r in got.collect()} == {"a": "SPEED", "b": None, "c": None, "d": "DESIGN"}


def test_context_in_the_search_is_the_column_expression(spark):
    r = random.Random(3)
    texts = ["".join(r.choice(["ab", "cd", " ", "  ", "\t", "\u3000", "\x1c", "é", "x"]) for _ in range(r.randint(0, 25))) for _ in range(150)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    spans = rows.select("t", F.explode(aspects.keyword_spans(F.col("t"), {"ab": 1.0, "cd": 1.0, "d ": 1.0, " ": 1.0}, {})).alias("s")).select("t", "s.*")
    both = spans.select("t", "start", "context", aspects.local_context(F.col("t"), F.col("start")).alias("other")).collect()
    assert len(both) > 200 and all(x["context"] == x["other"] for x in both)


class Busy(Exception):
    status_code = 429


class Wrong(Exception):
    status_code = 400


def test_remote_calls_are_tried_again():
    calls = []

    def call(text):
        calls.append(text)
        if text == "bad":
            raise Wrong
        if text == "never" or text == "twice" and len(calls) < 3:
            raise Busy
        if text == "odd":
            raise ValueError
        return text.upper()

    one = remote.retried(call, pause=0)
    for text, value, n in (("fine", "FINE", 1), ("twice", "TWICE", 3), ("never", None, 3), ("bad", None, 1), ("odd", None, 1)):
        calls.clear()
        assert one(text) == value and len(calls) == n, text


def test_only_the_days_ratings_are_grouped(spark):
    pending = spark.createDataFrame([("a", "p1")], "review_id string, platform_review_id string")
    pre = spark.createDataFrame([("a", "text")], "review_id string, refined_text string")
    reviews = spark.createDataFrame([("a", "p1", 1), ("b", "p2", 5)], "review_id string, platform_review_id string, rating int")
    found = spark.createDataFrame([], "review_id string, sentiment_score double")
    df = actions.analyze(pending, pre, reviews, found)
    assert df.first()["is_action_required"]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") >= 2


def one_by_one(text, terms, most):
    """Spans of N01, each term sought by itself."""
    found = []
    for term in terms:
        at = text.find(term)
        while at >= 0:
            if all(at + len(term) <= a or b <= at for _, a, b in found):
                found.append((term, at, at + len(term)))
                break
            at = text.find(term, at + 1)
        if len(found) == most:
            break
    return found


@settings(max_examples=500, deadline=None)
@given(st.text("abㄱ😀 ]^-\\", max_size=40), st.lists(st.text("abㄱ😀 ]^-\\", min_size=1, max_size=5), max_size=30), st.integers(1, 5))
def test_spans_as_one_by_one(text, terms, most):
    assert spans(text, ordered(terms), most) == one_by_one(text, ordered(terms), most)


def test_the_number_of_terms_does_not_matter():
    words = [f"word{k}" for k in range(3000)]
    text, few, many = " ".join(words), words[:100], [f"w{k:05d}x" for k in range(20_000)] + words[:100]

    def took(terms):
        finder, start = Finder(ordered(terms)), time.perf_counter()
        for _ in range(20):
            finder.spans(text)
        return time.perf_counter() - start

    assert took(many) < 8 * took(few) + 0.2  # 200 times the terms


def test_category_as_pairs(spark):
    """Prefixes either way round, the first category first; empty and null keywords, empty terms."""
    known = {"A": ("abc", "x"), "B": ("ab", "q😀z"), "C": ("abcd", "yy", "x"), "D": ()}
    words = ["", "a", "ab", "abc", "abcde", "x", "xx", "y", "yyy", "q", "q😀", "q😀zz", "nothing", None]
    for categories in (known, {"E": ("",), **known}, {"F": ()}, {}):
        pairs = lambda w: next((c for c, terms in categories.items() if any(w.startswith(t) or t.startswith(w) for t in terms)), None) if w is not None else None  # noqa: B023, E731
        got = spark.createDataFrame([(w,) for w in words], "w string").select("w", aspects.category(F.col("w"), categories).alias("c")).collect()
        assert {r["w"]: r["c"] for r in got} == {w: pairs(w) for w in words}, categories
