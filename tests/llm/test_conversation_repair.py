"""op13: the search against uniform-cost search, the registered query against plain Python, odd rows."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from pitmark.llm.conversation_repair import cheapest_edits, repair, repair_report
from pitmark.llm.queries import QUERIES, damaged

KEEPS = {"": "su", "s": "u", "u": "a", "a": "u"}
WHITE = "[^\x20\x09-\x0d]"


def plain_search(rows):
    """Uniform-cost search over (cost, letters); rows are (role initial, fault)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, letters, i, last = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, letters
        new = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 3, letters + "I", i, new))
        if i < len(rows):
            role, fault = rows[i]
            heapq.heappush(heap, (cost + 4, letters + "D", i + 1, last))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                heapq.heappush(heap, (cost + 3 + extra, letters + "R", i + 1, new))
                if role and role in KEEPS[last]:
                    heapq.heappush(heap, (cost + extra, letters + "K", i + 1, role))


def test_search_equals_uniform_cost_search():
    rng = random.Random(5)
    faults = ["", "truncated", "blank", "duplicate"]
    for _ in range(6000):
        rows = [(rng.choice("suaux"), rng.choice(["", "", *faults])) for _ in range(rng.randint(0, 10))]
        codes = bytes(4 * "suax".index(r) + faults.index(f) for r, f in rows)
        assert cheapest_edits(codes) == plain_search(rows), rows


@pytest.mark.parametrize(("codes", "want"), [(b"", (0, "")), (bytes([4, 8]), (0, "KK")), (bytes([0]), (4, "D")), (bytes([4]), (3, "KI")), (bytes([8]), (3, "IK")), (bytes([2, 7]), (8, "DD")), (bytes([4, 4]), (3, "KR")), (bytes([5]), (4, "D"))])
def test_literal_edits(codes, want):
    assert cheapest_edits(codes) == want


def test_long_conversations_take_linear_time():
    rng = random.Random(1)
    codes = bytes(rng.choice([0, 4, 8, 12, 1, 5, 9, 6, 7]) for _ in range(100_000))
    cost, letters = cheapest_edits(codes)
    assert cost > 0 and len(letters.replace("I", "")) == len(codes)


def plain(rows):
    """What the contract says of one conversation's rows after damage: (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, marks, counts = set(), [], defaultdict(int)
    for _, role, text in rows:
        last = re.findall(WHITE, text)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        marks.append((role[:1], fault))
    cost, audit = plain_search(marks)
    out, at, last = [], 0, ""
    for letter in audit:
        new = "a" if last == "u" else "u"
        if letter == "I":
            out.append(({"a": "assistant", "u": "user"}[new], ""))
            last = new
            continue
        _, role, text = rows[at]
        at += 1
        if letter != "D":
            last = new if letter == "R" else role[:1]
            out.append(({"a": "assistant", "u": "user"}[new] if letter == "R" else role, text))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r for r, _ in marks]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest), out


def plain_damage(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        said = lambda x: " " if x is None else str(x)
        role, text, k = said(role), said(text), zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        some = found[conv]
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            some += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return found


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_the_registered_query_equals_plain_python(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {conv: plain(some)[0] for conv, some in plain_damage(rows).items()}
    got = QUERIES["op13_conversation_repair"](spark, sf).collect()
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == want
    assert sum(w[5] > 0 for w in want.values()) > 20


def test_odd_rows(spark):
    rng = random.Random(9)
    pick = lambda *x: rng.choice(x)
    rows = [(pick(None, 1, 2, 3, 4, 5, 6), pick(None, -3, 0, 1, 1, 2, 9), pick(None, "", "user", "assistant", "system", "tool", "Üser"), pick(None, "", " \t\n", "a.", "a", "é!\x0b ", "b?" * 5000), 1) for _ in range(150)]
    rows += [(7, None, None, None, 1)] * 3 + [(8, 0, "user", "x.", 1)] * 400
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, digest int")
    want = {conv: plain(some) for conv, some in plain_damage([r[:4] for r in rows]).items()}
    hurt = damaged(df)
    got = repair_report(hurt, gone=hurt["gone"]).collect()
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == {c: w[0] for c, w in want.items()} and len(got) == len(want)
    out = defaultdict(list)
    for r in sorted(repair(hurt, gone=hurt["gone"]).collect(), key=lambda r: (str(r.conv_id), r.place)):
        assert r.place == len(out[r.conv_id])
        out[r.conv_id].append((r.role, r.text))
    assert {c: out[c] for c in want} == {c: w[1] for c, w in want.items()}
    assert repair(df.where("false")).collect() == [] and repair_report(df.where("false")).collect() == []


def test_conversations_that_have_gone_keep_a_row(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    (r,) = repair_report(df.withColumn("away", df.turn == 0), gone=df.turn == 0).collect()
    assert tuple(r) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
