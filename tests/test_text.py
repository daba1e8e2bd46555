import random
import re
import time
import unicodedata

import pandas as pd
from pyspark.sql import functions as F

from lakewright.functions import text
from lakewright.functions.keywords import Replacer


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first()["x"]


def test_nfkc(spark):
    assert one(spark, text.normalize_unicode, "１２３") == "123"
    assert one(spark, text.normalize_unicode, "각") == "각"
    assert one(spark, text.normalize_unicode, None) is None
    assert one(spark, text.normalize_unicode, "plain") == "plain"


def test_emoji(spark):
    assert one(spark, text.remove_emojis, "앱이 너무 좋아요 😊👍") == "앱이 너무 좋아요 "
    assert one(spark, text.remove_emojis, "그냥 글 123") == "그냥 글 123"
    assert one(spark, text.remove_emojis, "1️⃣번") == "번"


def test_emoji_guard_covers_all_characters(spark):
    points = [k for k in range(0x20000) if not 0xD800 <= k < 0xE000]
    df = spark.createDataFrame(pd.DataFrame({"t": [f"a{chr(k)}b" for k in points] + ["1\u20e3", "#\ufe0f\u20e3", "\U0001f1f0\U0001f1f7"]}))
    assert df.filter(~text.remove_emojis(F.col("t")).eqNullSafe(F.regexp_replace("t", text.EMOJI, ""))).count() == 0


def test_squeeze(spark):
    assert one(spark, text.reduce_repeated_chars, "ㅋㅋㅋㅋ") == "ㅋㅋ"
    assert one(spark, text.reduce_repeated_chars, "hhhh") == "hh"
    assert one(spark, text.reduce_repeated_chars, "ㅋㅋ") == "ㅋㅋ"
    assert one(spark, text.reduce_repeated_chars, "a\n\n\n\nb") == "a\n\n\n\nb"


def test_special(spark):
    assert one(spark, text.remove_special_chars, "좋아요! 정말? 최고.") == "좋아요! 정말? 최고."
    assert one(spark, text.remove_special_chars, "계좌: (비밀)") == "계좌 비밀"


def test_pii(spark):
    assert one(spark, text.mask_pii, "계좌번호는 1234567890 입니다") == "계좌번호는 [ACC] 입니다"
    assert one(spark, text.mask_pii, "계좌: 123-456-789012") == "계좌: [ACC]"
    assert one(spark, text.mask_pii, "123-456-789012로") == "123-456-789012로"  # a letter follows: no border
    assert one(spark, text.mask_pii, "전화번호 010-1234-5678로 연락") == "전화번호 [TEL]로 연락"
    assert one(spark, text.mask_pii, "이메일: user@example.com 보내주세요") == "이메일: [EMAIL] 보내주세요"
    assert one(spark, text.mask_pii, "9901012345678") == "99[TEL]"


def test_whitespace(spark):
    assert one(spark, lambda c: text.strip(text.normalize_whitespace(c)), "좋은  \t앱\n\n입니다") == "좋은 앱 입니다"


def test_clean(spark):
    f = lambda c: text.clean(c, {"게좌이체": "계좌이체"}, ["욕설1"])
    # NFKC turns compatibility letters into conjoining ones
    assert one(spark, f, "게좌이체😊ㅋㅋㅋㅋ 욕설1 010-1234-5678") == "계좌이체" + unicodedata.normalize("NFKC", "ㅋㅋ") + " [SLANG] [TEL]"
    assert one(spark, lambda c: text.clean(c, None, {"욕설A": "[MASK]"}), "욕설A 맞다") == "[MASK] 맞다"
    assert one(spark, f, "") == ""
    assert one(spark, f, None) is None


def test_replacer_borders():
    r = Replacer({"sol": "S", "sol pay": "P", "쏠": "Q"})
    assert r.replace("sol pay SOL solar 쏠쏠 xsol") == "P S solar QQ xsol"
    assert Replacer({}).replace("a") == "a"


def test_replacer_agrees_with_trying_every_keyword():
    rng = random.Random(5)
    some = lambda chars, most: "".join(rng.choice(chars) for _ in range(rng.randint(1, most)))
    for _ in range(300):
        words = {some("aB쏠 -_", 4): some("xyz", 2) for _ in range(rng.randint(1, 8))}
        lowered = {k.lower(): v for k, v in words.items()}
        body = "|".join(map(re.escape, sorted(lowered, key=lambda k: (-len(k), k))))
        plain = re.compile(rf"(?<![0-9A-Za-z_])(?:{body})(?![0-9A-Za-z_])", re.I)
        line = some("aAbB쏠 -_.", 40)
        assert Replacer(words).replace(line) == plain.sub(lambda m: lowered[m[0].lower()], line)
    assert Replacer({"B": "x"}).replace("İİ b") == "İİ x"  # whose lower case is longer


def test_replacer_of_a_large_dictionary():
    r = Replacer({f"wort{k}": f"w{k}" for k in range(200_000)})
    start = time.perf_counter()
    assert r.replace("wort199999 wort wort1x " * 5_000) == "w199999 wort wort1x " * 5_000
    assert time.perf_counter() - start < 5


def test_clean_plan_has_one_hop_per_udf_group(spark):
    plan = spark.createDataFrame([("x",)], "t string").select(text.mask_pii(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
