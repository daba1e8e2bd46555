import random
import re

from lakewright.llm import decontaminate as d

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return W.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    w, hit, who = words(text), set(), set()
    for name, body in items:
        b = words(body)
        n = min(10, len(b))
        for i in range(len(b) - n + 1) if n else ():
            for j in range(len(w) - n + 1):
                if w[j : j + n] == b[i : i + n]:
                    hit |= set(range(j, j + n))
                    who.add(str(name))
    return len(w), len(hit), len(who), d.sha256_of(sorted(who)), bool(hit)


def cases():
    r = random.Random(3)
    vocabulary = [f"w{k}é" if k % 5 == 0 else f"W{k}" for k in range(12)]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(n))) for k, n in enumerate((25, 14, 10, 3, 1, 11, 0))] + [(7, None), (8, "same words here"), (9, "Same, words... HERE")]
    texts = [None, "", "nothing", "the same words here!"]
    for _ in range(40):
        parts = [r.choice(vocabulary) for _ in range(r.randint(0, 30))]
        if r.random() < 0.6:
            b = r.choice(items[:6])[1].split()
            a = r.randint(0, max(0, len(b) - 5))
            parts[5:5] = b[a : a + r.randint(8, 16)]
        texts.append(" ".join(parts))
    return texts, items


def test_as_brute_force(spark, documents):
    texts, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = d.query(documents(texts), bench).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in rows] == [brute(t, items) for t in texts]


def test_blocks_give_the_same(spark, documents, monkeypatch):
    texts, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(d, "BLOCK_WORDS", 40)
    assert len(d._blocks(bench)) > 2
    rows = d.query(documents(texts), bench).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in rows] == [brute(t, items) for t in texts]


def test_one_block_at_a_time(spark, documents, monkeypatch):
    """Of five blocks and more, each is destroyed before the next one is sent, and what the stage cuts out stays the same."""
    texts, items = cases()
    items = [(k, t) for k, t in items if t and len(t.split()) > 3]  # else every text loses too much
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(str, d.stage(documents(texts), bench, max_share=0.9).collect()))
    monkeypatch.setattr(d, "BLOCK_WORDS", 10)
    blocks, alive, most = len(d._blocks(bench)), set(), []
    send = spark.sparkContext.broadcast

    def counted(value):
        sent = send(value)
        alive.add(id(sent))
        most.append(len(alive))
        destroy = sent.destroy
        sent.destroy = lambda blocking=False: (alive.discard(id(sent)), destroy(blocking))
        return sent

    monkeypatch.setattr(spark.sparkContext, "broadcast", counted)
    assert sorted(map(str, d.stage(documents(texts), bench, max_share=0.9).collect())) == whole
    assert blocks >= 5 and most == [1] * blocks


def test_stage(spark, documents):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    rest = "Here stands a text that goes on for quite some time before and after it"
    docs = documents([f"{rest} {passage.upper()}, {rest}", passage, rest, None])
    out = d.stage(docs, bench)
    assert out.columns == docs.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert sorted(rows) == [0, 2, 3]
    assert rows[0]["text"] == f"{rest}, {rest}" and rows[0]["n_chars"] == len(rows[0]["text"]) and rows[2]["text"] == rest


def test_item_without_id_and_repeated_items(spark, documents):
    bench = spark.createDataFrame([(None, "a b c"), (4, "x y"), (4, "x y"), (4, "y z")], "item_id long, text string")
    rows = d.query(documents(["a b c x y z", "a b c"]), bench).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in rows] == [(6, 6, 1, d.sha256_of(["4"]), True), (3, 3, 0, d.sha256_of([]), True)]


def test_empty(spark, documents):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[1:4] for r in d.query(documents(["a b"]), bench).collect()] == [(2, 0, 0)]
    assert d.query(documents([]).limit(0), bench).count() == 0
