import hashlib
import itertools
import random
import re
import zlib

from lakewright.llm import turn_repair

LEGAL = re.compile(r"(s?(ua)+)?\Z")


def cheapest_of_all(rows):
    """(cost, audit) over every choice of edits, inserts of up to two turns at each place."""
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    kinds = [[e for e in "KUAD" if e == "D" or f in "gc"] for _, f in rows]
    for edits in itertools.product(*kinds):
        for ins in itertools.product(gaps, repeat=len(rows) + 1):
            roles, audit, cost = ins[0], "I" * len(ins[0]), 3 * len(ins[0])
            for (letter, f), e, more in zip(rows, edits, ins[1:]):
                roles += {"K": letter, "U": "u", "A": "a", "D": ""}[e] + more
                audit += {"K": "K", "U": "R", "A": "R", "D": "D"}[e] + "I" * len(more)
                cost += {"K": 0, "U": 3, "A": 3, "D": 4}[e] + (3 if f == "c" and e != "D" else 0) + 3 * len(more)
            if LEGAL.match(roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def by_rows(rows):
    """The same by going from row to row with the best of each state."""
    keep = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    made = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserts(best):
        for _ in range(2):
            for q, (c, a) in list(best.items()):
                best[made[q]] = min(best.get(made[q], (1 << 60, "")), (c + 3, a + "I"))
        return best

    best = inserts({"": (0, "")})
    for letter, f in rows:
        after = {}
        for q, (c, a) in best.items():
            ways = [(q, 4, "D")]
            if f in "gc":
                more = 3 if f == "c" else 0
                ways.append((made[q], 3 + more, "R"))
                if not letter or (q, letter) in keep:
                    ways.append((keep[q, letter] if letter else q, more, "K"))
            for to, x, e in ways:
                after[to] = min(after.get(to, (1 << 60, "")), (c + x, a + e))
        best = inserts(after)
    return min(best[q] for q in ("", "a") if q in best)


def brute(rows):
    """rows: (conv_id, turn, role, text)."""
    out = []
    for conv in dict.fromkeys(r[0] for r in rows):
        own = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if fault == 0:
                continue
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            role = "user" if fault == 4 else role
            own += [(turn, role, text)] * (2 if fault == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in own:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("b" if not words else "r" if (role, text) in seen else "c" if words[-1] not in ".!?" else "g")
            seen.add((role, text))
        turns = {t for t, _, _ in own if t is not None}
        letters = [r[:1] for _, r, _ in own]
        cost, audit = by_rows(list(zip(letters, faults)))
        lines, at, state = [], iter(own), ""
        for e in audit:
            _, role, text = next(at) if e != "I" else (None, None, "")
            if e in "IR":
                role = "assistant" if state == "u" else "user"
            if e != "D":
                lines.append(f"{role}:{text}")
                state = role[:1] or state
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *(faults.count(x) for x in "brc"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def check(spark, rows, part=turn_repair.PART):
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, audit string")
    got = turn_repair.repaired(df, part)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows), key=str)
    return df


def test_search_against_all_edits():
    rng = random.Random(5)
    for _ in range(120):
        rows = [(rng.choice("suat"), rng.choice("ggbrc")) for _ in range(rng.randrange(4))]
        want = cheapest_of_all(rows)
        assert by_rows(rows) == want, rows
        assert min(turn_repair.search(rows, 0, turn_repair.ENDS, 1).values()) == want, rows


def test_parts_do_not_show():
    rng = random.Random(6)
    for n in range(60):
        rows = [(rng.choice(["s", "u", "a", "u", "a", "t", ""]), rng.choice("ggggbrc")) for _ in range(n)]
        for part in (1, 3, 7, 1000):
            repair = turn_repair.Repair(part)
            for r in rows:
                repair.add(*r)
            assert repair.result() == by_rows(rows), (part, rows)


def conversations(rng, n):
    texts = ["Yes.", "No!", "Why?", "and then", "", "  ", None, "So. ", "Ünï."]
    roles = ["user", "assistant", "system", "tool", None, "", "u"]
    for conv in range(n):
        for turn in range(rng.randrange(1, 12)):
            role = roles[turn % 2] if rng.random() < 0.8 else rng.choice(roles)
            yield conv, turn if rng.random() < 0.9 else None, role, rng.choice(texts) if rng.random() < 0.3 else f"Text {turn}."


def test_against_brute_force(spark):
    rows = list(conversations(random.Random(7), 150))
    rows += [(None, 0, "user", "Null id."), (None, None, None, None), (900, None, "user", "a."), (900, None, "user", "a."), (901, 5, "user", "x" * 100_000 + ".")]
    check(spark, rows + rows[:40])  # repeated rows


def test_a_long_conversation_goes_part_by_part(spark):
    rng = random.Random(8)
    check(spark, [(1, k, rng.choice(["user", "assistant"]), rng.choice([f"T{k}.", f"T{k}", "same."])) for k in range(700)], part=50)


def test_turns_give_the_repaired_texts(spark):
    rows = [(k % 20, k // 20, "user" if rng else "assistant", f"t{k}.") for k, rng in enumerate(random.Random(9).choices([0, 1], k=120))]
    df = check(spark, rows)
    hashes = {r.conv_id: r.repaired_sha256 for r in turn_repair.repaired(df).collect()}
    texts = {c: [] for c in hashes}
    for r in turn_repair.turns(df).collect():
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in texts.items()} == hashes


def test_all_rows_dropped_and_no_rows(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    check(spark, [(conv, 0, "user", "Gone.")])
    check(spark, [])
