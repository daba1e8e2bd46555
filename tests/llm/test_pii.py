import random
import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from lakewright.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    digits = re.sub(r"\D", "", text)
    if kind == "email":
        return True
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    total = sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(digits[::-1]))
    return 12 <= len(digits) <= 19 and total % 10 == 0


def brute(text):
    out = [(m.start(), list(PATTERNS).index(k), f"{k}:{m.start()}:{m.end()}") for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])]
    return [x for _, _, x in sorted(out)]


def base_of(text):
    return [(int(a), int(b), kind) for kind, a, b in (x.split(":") for x in brute(text))]


def loose(text, spans):
    """Identifier-like tokens that meet none of spans, each compared with each."""
    for m in pii._TOKEN.finditer(text):
        token = m[0].rstrip(".!?%&*$#")
        a, b = m.start(), m.start() + len(token)
        if len(token) >= 6 and re.search("[0-9]", token) and not any(a < high and low < b for low, high, _ in spans):
            yield a, b, token


def brute_learn(texts):
    """{pattern: (kind, confidence)}: the graph as a dictionary, scored by loops."""
    edges, seeds, total = Counter(), defaultdict(set), Counter()
    for text in texts:
        spans = base_of(text)
        several = [(a, text[a:b], kind) for a, b, kind in spans]
        several += [(a, x, "secret" if pii._HEX.match(x) or pii._KEY.match(x) else None) for a, _, x in loose(text, spans)]
        for a, token, kind in several:
            for pattern in pii.patterns_at(text, a, token):
                edges[pattern, token, kind is not None] += 1
                if kind:
                    seeds[pattern].add((token, kind))
        for word in text.lower().split():
            total[word + " "] += 1
            if len(word) >= 4:
                total["^" + word[:4]] += 1
        for word, sign in pii._ASSIGN.findall(text):
            total[word.lower() + sign] += 1
    wanted = {p for p, s in seeds.items() if len(s) >= pii.SUPPORT and total[p]}
    score, confidence = {}, {}
    for _ in range(pii.ROUNDS):
        for p in wanted:
            own = [(n, 1.0 if seed else score.get(token, 0.0)) for (q, token, seed), n in edges.items() if q == p]
            confidence[p] = sum(n * s for n, s in own) / max(total[p], sum(n for n, _ in own))
        left = defaultdict(lambda: 1.0)
        for (p, token, seed), _ in edges.items():
            if p in wanted and not seed:
                left[token] *= 1 - min(0.99, confidence[p])
        score = {token: 1 - x for token, x in left.items()}
    kinds = {p: max((n, k) for k, n in Counter(k for _, k in seeds[p]).items())[1] for p in wanted}
    return {p: (kinds[p], c) for p, c in confidence.items() if c >= pii.CONFIDENCE}


def all_spans(text, accepted):
    base = base_of(text)
    more = [(a, b, next((accepted[p][0] for p in pii.patterns_at(text, a, token) if p in accepted), None)) for a, b, token in loose(text, base)]
    return sorted({*base, *(x for x in more if x[2])}, key=pii.order)


def corpus(r, n):
    """Texts with identifiers in contexts that are more or less certain."""
    hexa = lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.randint(16, 30)))
    short = lambda: "".join(r.choice("abcdef") for _ in range(5)) + str(r.randint(10, 9999))
    mail = lambda: f"{r.choice('abcdefgh')}{r.choice(['', '7'])}{r.choice('xyz')}@mail.{r.choice(['org', 'de'])}"
    plain = lambda: r.choice(["morning", "house", "waterfall", "token", "user", "2024-01-01", "b2b-sales"])
    makers = {"token=": (hexa, hexa, short), "secret: ": (hexa, short, short, plain), "user ": (mail, mail, short), "key = ": (hexa, hexa, hexa, plain, plain), "by ": (mail, plain, plain)}
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(r.randint(1, 6)):
            lead = r.choice(list(makers))
            parts += [plain(), lead + r.choice(makers[lead])() + r.choice(["", ".", "!"])]
        texts.append(" ".join(parts))
    return texts


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aZ9@.-+ ()%_123é\n", max_size=60))
def test_base_spans_as_brute_force(text):
    assert pii._written(pii.base_spans(text)) == brute(text)


def test_long_texts_stay_linear():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1 " * 100_000, "+1" + " (" * 100_000, "1." * 100_000, "@" * 200_000):
        pii.base_spans(text)


SECRETS = [f"log says token = \"{k:016x}ab{k:014x}c1\" here" for k in range(1, 12)] + ["then token = \"hunter22\" came", "token of love", "of 12 things", "x1y2z3 alone"]


def test_query(spark, documents):
    texts = [*SECRETS, "mail a.b@c.de or +1 (212) 555-0100 at 10.0.0.1, card 4111 1111 1111 1111", None, "", "mail a.b@c.de"]
    rows = pii.query(documents(texts)).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    assert [r["spans"] for r in rows if "hunter22" in (texts[r["doc_id"]] or "")] == ["secret:14:22"]
    assert [r["spans"] for r in rows][13:15] == ["", ""]  # few seeds around: nothing new
    full = rows[len(SECRETS)]
    assert (full["n_email"], full["n_ip"], full["n_card"], full["n_phone"]) == (1, 1, 1, 1)
    assert full["base_sha256"] == pii.sha256_of(brute(texts[len(SECRETS)]))
    assert rows[len(SECRETS) + 1]["base_sha256"] == pii.sha256_of([]) and rows[len(SECRETS) + 1]["spans"] == ""


def test_learning(spark, documents):
    got = {r["pattern"]: r for r in pii.learn(documents(SECRETS)).collect()}
    assert got["token="]["kind"] == "secret" and got["token="]["confidence"] > 0.9
    assert "of " not in got


def test_bootstrapping_as_brute_force(spark, documents):
    texts = corpus(random.Random(3), 300)
    accepted = brute_learn(texts)
    docs = documents(texts)
    got = {x["pattern"]: (x["kind"], x["confidence"]) for x in pii.learn(docs).collect()}
    assert {p: (k, round(c, 9)) for p, (k, c) in got.items()} == {p: (k, round(c, 9)) for p, (k, c) in accepted.items()}
    assert "token=" in accepted and "by " not in accepted
    spans = {x["doc_id"]: x["spans"] for x in pii.query(docs).collect()}
    assert spans == {k: ",".join(f"{kind}:{a}:{b}" for a, b, kind in all_spans(t, accepted)) for k, t in enumerate(texts)}
    assert sum(len(all_spans(t, accepted)) - len(base_of(t)) for t in texts) > 100


def test_many_patterns_give_the_same(spark, documents, monkeypatch):
    """Patterns counted by a shuffle and taken in several passes: as in one broadcast, the ones of the token's own letters last."""
    docs = documents([*corpus(random.Random(5), 200), "token=user12ab x", "user abcd77", None])
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    learnt = {r["pattern"]: tuple(r) for r in pii.learn(docs).collect()}
    some = spark.createDataFrame([("token=", "secret"), ("^user", "email"), ("user ", "ip"), ("^abcd", "card"), ("key=", "phone")], "pattern string, kind string")
    accepted = {r["pattern"]: (r["kind"], 1.0) for r in some.collect()}
    monkeypatch.setattr(pii, "PATTERNS", 2)
    again = {r["pattern"]: tuple(r) for r in pii.learn(docs).collect()}
    close = lambda x: {p: (k, round(c, 9), s) for p, (_, k, c, s) in x.items()}
    assert close(again) == close(learnt) and set(learnt) == {"token=", "key="}
    got = {r["row"]["doc_id"]: r["spans"] for r in pii.find(docs, patterns=some).collect()}
    assert got == {k: pii._written(all_spans(t, accepted)) if t else [] for k, t in texts.items()}
    assert got[200] == ["secret:6:14"] and got[201] == ["ip:5:11"]


def test_empty_table(spark, documents):
    assert pii.query(documents([]).limit(0)).count() == 0


def test_stage(spark, documents):
    docs = documents(["write to a.b@c.de now", None, "plain"])
    out = pii.stage(docs)
    assert out.columns == docs.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[0]["text"] == "write to [EMAIL] now" and rows[0]["n_chars"] == len("write to [EMAIL] now")
    assert rows[1]["text"] is None and rows[2]["text"] == "plain"


def test_mask_overlaps():
    assert pii.mask("abcdef", [(0, 3, "ip"), (2, 5, "card")]) == "[IP]f"


def test_seeds_in_texts_without_digits_count(spark, documents):
    texts = [f"contact: {a}{b}{c}@mail.org" for a in "abcd" for b in "efgh" for c in "ijkl"] + [f"contact: x{k}@mail.org" for k in range(36)]
    rows = pii.query(documents([*texts, "contact: 7user77"])).collect()
    assert [r["spans"] for r in rows if r["doc_id"] == len(texts)] == ["email:9:16"]


def test_long_identifiers(spark, documents):
    part = "eyJhbGciOiJIUzI1NiJ9_-"
    jwt = ".".join([part * 3, part * 9, part * 5])
    long = [f"log says key = {k:0200x}a1 here" for k in range(1, 12)]  # seeds of over 128 characters
    rows = pii.query(documents([*SECRETS, *long, f"then token = {jwt} came", f"a key = {jwt}."])).collect()
    got = {r["doc_id"]: r["spans"] for r in rows}
    at = len(SECRETS) + len(long)
    assert got[at] == f"secret:13:{13 + len(jwt)}" and got[at + 1] == f"secret:8:{8 + len(jwt)}"
    assert pii.stage(documents([*SECRETS, f"then token = {jwt} came"])).filter(f"doc_id = {len(SECRETS)}").first()["text"] == "then token = [SECRET] came"
    names = {r["pattern"]: r["support"] for r in pii.learn(documents([*SECRETS, *long])).collect()}
    assert names["key="] == len(long)
