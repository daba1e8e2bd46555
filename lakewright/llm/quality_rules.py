"""Line-first quality rules, all in DataFrame functions (no Python on the executors).

Every line of a document is judged by itself; failing lines are removed, and a document that loses
more than `MAX_LOST` of its characters is rejected, as is one that fails the base rules.

A line fails when it
  * is mostly marks: `[#*$%&|<>]` make up over a tenth of it, or `!`/`?` come to over half its words (from 4 words on),
  * is navigation: three or more `|` or `»`, which in a line of over `SHORT_LINE` characters are over one in `MARKS_SHARE`,
  * is boilerplate: cookie notices, rights notices, sign-up prompts, script notices, which make up over a tenth of such a line,
  * is shouted: from 5 words on, more than half of its characters are ASCII capitals,
  * stutters: from 8 words on, fewer than a third of its words are different ones, and so are those of its stretches of
    `STRETCH` words in sum.

So a text without line breaks is not lost for one mark or phrase. The query, its SQL and the pipeline's stage take the same rules.

Defined results: null or empty text has no words and is rejected (n_words < 20); blank lines never
fail; repeated rows are judged alike; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm import common

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MAX_LOST = 0.5
#: In characters, in characters for each mark, in words.
SHORT_LINE, MARKS_SHARE, STRETCH = 300, 40, 64
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
NAVIGATION = r"[|»][^|»]*[|»][^|»]*[|»]"
#: Compared with the lower-cased line.
BOILERPLATE = (
    "accept cookies", "accept all cookies", "cookie policy", "all rights reserved", "privacy policy", "terms of use",
    "terms of service", "enable javascript", "sign up for our newsletter", "click here to",
)


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _stretched(words: Column) -> Column:
    """The sum of the numbers of different words in each stretch of a line."""
    starts = F.sequence(F.lit(1), F.size(words), F.lit(STRETCH))
    return F.aggregate(starts, F.lit(0), lambda a, i: a + F.size(F.array_distinct(F.slice(words, i, F.lit(STRETCH)))))


def _line_fails(x: Column) -> Column:
    """x: struct of a line `t`, its words `w` and the lower-cased line `low` (each computed once)."""
    line, n = x["t"], F.size(x["w"])
    short = F.length(line) <= SHORT_LINE
    navigation = line.rlike(NAVIGATION) & (short | (_count(line, "[|»]") * MARKS_SHARE > F.length(line)))
    stutter = (n >= 8) & (F.size(F.array_distinct(x["w"])) * 3 < n) & ((n <= STRETCH) | (_stretched(x["w"]) * 3 < n))
    boilerplate = x["low"].contains(BOILERPLATE[0])
    for phrase in BOILERPLATE[1:]:
        boilerplate = boilerplate | x["low"].contains(phrase)
    boilerplate = boilerplate & (short | (_count(x["low"], "|".join(BOILERPLATE)) * 10 > F.length(line)))
    return (
        (_count(line, SYMBOLS) * 10 > F.length(line))
        | ((n >= 4) & (_count(line, "[!?]") * 2 > n))
        | navigation
        | ((n >= 5) & (_count(line, "[A-Z]") * 2 > F.length(line)))
        | stutter
        | boilerplate
    )


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs as common.apart() has them, and a struct `q` with the base statistics, the verdict and the cleaned text."""
    out = common.apart(docs, text).withColumn("t", F.coalesce("body", F.lit("")))
    out = out.withColumn("w", F.array_remove(F.split("t", SPACE + "+"), ""))
    out = out.withColumn(
        "l",
        F.transform(F.split("t", "\n", -1), lambda x: F.struct(x.alias("t"), F.split(F.trim(x), SPACE + "+").alias("w"), F.lower(x).alias("low"))),
    )
    out = out.withColumn(
        "h",
        F.when(
            F.size("w") >= WINDOW,
            F.transform(F.sequence(F.lit(1), F.size("w") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(F.col("w"), i, F.lit(WINDOW)))),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    # only texts that repeat a window go on to the sort
    ordered = F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), ordered))
    out = out.withColumn(
        "d",
        F.when(
            F.col("s").isNotNull(),
            F.sort_array(
                F.transform(
                    F.filter(
                        F.transform(
                            F.col("s"),
                            lambda x, j: F.struct(
                                x["i"].alias("i"),
                                (
                                    (F.get(F.col("s"), j - 1)["h"].eqNullSafe(x["h"]))
                                    | (F.get(F.col("s"), j + 1)["h"].eqNullSafe(x["h"]))
                                ).alias("twice"),
                            ),
                        ),
                        lambda x: x["twice"],
                    ),
                    lambda x: x["i"],
                )
            ),
        ).otherwise(F.array().cast("array<int>")),
    )
    covered = F.aggregate(
        F.transform(F.col("d"), lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("d"), j + 1) - i, F.lit(WINDOW)))),
        F.lit(0),
        lambda a, x: a + x,
    )
    solid = F.transform(F.filter("l", lambda x: x["t"].rlike(r"[^\x20\x09-\x0D]")), lambda x: x["t"])
    out = out.withColumn("solid", solid)
    good = F.filter("l", lambda x: ~(x["t"].rlike(r"[^\x20\x09-\x0D]") & _line_fails(x)))
    out = out.withColumn("good", F.transform(good, lambda x: x["t"]))
    out = out.withColumn(
        "q",
        F.struct(
            F.size("w").cast("long").alias("n_words"),
            F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
            _count(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
            (F.size("solid") - F.size(F.array_distinct("solid"))).cast("long").alias("n_dup_lines"),
            covered.cast("long").alias("n_repeat_words"),
            F.array_join("good", "\n").alias("clean_text"),
            F.length("t").alias("n_chars"),
        ),
    )
    q = F.col("q")
    failed = (q["n_words"] < MIN_WORDS) | (q["n_repeat_words"] * 100 > q["n_words"] * MAX_REPEAT_PERCENT)
    lost = q["n_chars"] - F.length(q["clean_text"])
    out = out.withColumn("q", q.withField("base_failed", failed).withField("kept", ~failed & (lost <= q["n_chars"] * F.lit(MAX_LOST))))
    return out.drop("t", "w", "l", "h", "s", "d", "solid", "good")


def stage(docs: DataFrame) -> DataFrame:
    """The kept documents with their failing lines removed, in the columns of docs (`n_chars` follows the text)."""
    q = F.col("q")
    # a filter is not moved below a projection that holds an id of its own; moved, it would compute every statistic again
    out = judge(docs).withColumn("at", F.monotonically_increasing_id()).filter(q["kept"] & (F.col("at") >= 0))
    return common.together(out.select("row", q["clean_text"].alias("body"), F.lit(True).alias("changed")), docs)


def query(docs: DataFrame) -> DataFrame:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judge(docs.select("doc_id", "text")).select("row.doc_id", *[F.col("q")[n].alias(n) for n in names])


_LINE_FAILS_SQL = r"""(
    (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g'))) * 10 > length(x)
    OR (len(__WORDS__) >= 4 AND (length(x) - length(regexp_replace(x, '[!?]', '', 'g'))) * 2 > len(__WORDS__))
    OR (regexp_matches(x, '[|»][^|»]*[|»][^|»]*[|»]') AND (length(x) <= 300 OR (length(x) - length(regexp_replace(x, '[|»]', '', 'g'))) * 40 > length(x)))
    OR (len(__WORDS__) >= 5 AND (length(x) - length(regexp_replace(x, '[A-Z]', '', 'g'))) * 2 > length(x))
    OR (len(__WORDS__) >= 8 AND len(list_distinct(__WORDS__)) * 3 < len(__WORDS__) AND (len(__WORDS__) <= 64
        OR list_sum(list_transform(range(1, len(__WORDS__) + 1, 64), lambda i: len(list_distinct(__WORDS__[i:i + 63])))) * 3 < len(__WORDS__)))
    OR ((__BOILERPLATE__) AND (length(x) <= 300 OR (length(lower(x)) - length(regexp_replace(lower(x), '__PHRASES__', '', 'g'))) * 10 > length(x)))
)"""
for _name, _put in (("__WORDS__", r"string_split_regex(trim(x, ' '), '[\x20\x09-\x0D]+')"), ("__BOILERPLATE__", " OR ".join(f"contains(lower(x), '{p}')" for p in BOILERPLATE)), ("__PHRASES__", "|".join(BOILERPLATE))):
    _LINE_FAILS_SQL = _LINE_FAILS_SQL.replace(_name, _put)

#: Filter and statistics of judge(), for DuckDB; `FROM_DOCS` is replaced by the table.
JUDGE_SQL = (
    r"""
q_docs AS (
    SELECT row_number() OVER () AS rid, *, coalesce(text, '') AS t FROM FROM_DOCS
), q_words AS (
    SELECT rid, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, string_split(t, chr(10)) AS l, t FROM q_docs
), q_windows AS (
    SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS win FROM q_words, unnest(range(1, len(w) - 6)) AS u(i)
), q_twice AS (
    SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM q_windows) WHERE c > 1
), q_cover AS (
    SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM q_twice) GROUP BY rid
), q_stats AS (
    SELECT rid, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words, length(t) AS chars,
        array_to_string(list_filter(l, lambda x: NOT (regexp_matches(x, '[^\x20\x09-\x0D]') AND """
    + _LINE_FAILS_SQL
    + r""")), chr(10)) AS clean_text
    FROM q_words LEFT JOIN q_cover USING (rid)
), q_judged AS (
    SELECT *, (n_words < 20 OR n_repeat_words * 100 > n_words * 30) AS base_failed,
        NOT (n_words < 20 OR n_repeat_words * 100 > n_words * 30) AND chars - length(clean_text) <= chars * 0.5 AS kept
    FROM q_stats
)"""
)

SQL = (
    "WITH "
    + JUDGE_SQL.replace("FROM_DOCS", "documents")
    + """
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
    n_repeat_words, base_failed, kept
FROM q_docs JOIN q_judged USING (rid)"""
)
