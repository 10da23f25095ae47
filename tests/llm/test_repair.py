import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from beaconflow.llm import repair
from beaconflow.llm.repair import align, damage, repair_conversations

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {"0s": "S", "0u": "A", "Su": "A", "Aa": "E", "Eu": "A"}


def least(initials, forced, cut):
    """(cost, audit) by trying every edit in every state of the grammar."""

    @lru_cache(None)
    def go(i, state, inserted):
        found = [(0, "")] if i == len(initials) and state in "0E" else []
        if i < len(initials):
            cost, audit = go(i + 1, state, 0)
            found.append((4 + cost, "D" + audit))
            for x in "sua":
                if not forced[i] and state + x in NEXT:
                    cost, audit = go(i + 1, NEXT[state + x], 0)
                    if initials[i] == x:
                        found.append((3 * cut[i] + cost, "K" + audit))
                    if x != "s":
                        found.append((3 * cut[i] + 3 + cost, "R" + audit))
        for x in "ua":
            if inserted < 4 and state + x in NEXT:
                cost, audit = go(i, NEXT[state + x], inserted + 1)
                found.append((3 + cost, "I" + audit))
        return min(found, default=(10**9, ""))

    return go(0, "0", 0)


@pytest.mark.parametrize("cells, turns", [(1 << 22, 11), (10, 25)])
def test_alignment_is_the_cheapest_and_the_least(monkeypatch, cells, turns):
    """Also with few rows kept, where the way back computes the others anew."""
    monkeypatch.setattr(repair, "CELLS", cells)
    rng = random.Random(9)
    for _ in range(1500):
        n = rng.randrange(1, turns)
        initials = "".join(rng.choice("suauaua ") for _ in range(n))
        forced, cut = ([rng.random() < 0.2 for _ in range(n)] for _ in range(2))
        assert align(initials.encode(), np.array(forced), np.array(cut)) == least(initials, tuple(forced), tuple(cut))


def damaged(rows):
    out = {}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out.setdefault(c, []).extend([(t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    return out


def brute(conversations):
    """conv_id -> the row of the contract, for conv_id -> [(turn, role, text)]."""
    out = {}
    for c, rows in conversations.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in rows:
            shown = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in rows]
        turns = {t for t, _, _ in rows if t is not None}
        cost, audit = least(initials, tuple(f in ("blank", "duplicate") for f in faults), tuple(f == "truncated" for f in faults))
        shown, i, expect = [], 0, "user"
        for letter in audit:
            role, text = ("", "") if letter == "I" else rows[i][1:]
            i += letter != "I"
            if letter != "D":
                role = role if letter == "K" else expect
                shown.append(f"{role}:{text}")
                expect = "user" if role[:1] in "sa" else "assistant"
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        counts = tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
        out[c] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(shown).encode()).hexdigest())
    return out


def judged(df):
    out = {}
    for r in df.collect():
        shown = "\n".join(f"{t.role}:{t.text}" for t in r.repaired)
        digest = hashlib.sha256(shown.encode()).hexdigest()
        out[r.conv_id] = (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digest)
    return out


def test_matches_brute_force_on_the_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert judged(repair_conversations(damage(table))) == brute(damaged(rows))


def test_faults_of_every_kind(spark):
    rng, rows = random.Random(2), []
    texts = ["Yes.", "No!", "Why?", "cut", "", " \t", "é", "Yes. \n", "a "]
    for c in range(150):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([t, t + 2, None]), rng.choice(["system", "user", "assistant", "assistant", "tool", "", None]), rng.choice(texts)))
    df = spark.createDataFrame(rows, SCHEMA)
    assert judged(repair_conversations(damage(df))) == brute(damaged(rows))
    plain = {}
    for c, t, role, text in rows:
        plain.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    assert judged(repair_conversations(df)) == brute(plain)


def test_edge_cases(spark):
    empty = hashlib.sha256(b"").hexdigest()
    dropped = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    rows = [(7, dropped, "user", "x."), (None, 1, "user", "x."), (8, None, None, None)]
    got = judged(repair_conversations(damage(spark.createDataFrame(rows, SCHEMA))))
    assert got[7] == (0, 0, 0, 0, 0, 0, "", empty) and set(got) == {7, None, 8}
    want = brute(damaged(rows))
    assert (got[8], got[None]) == (want[8], want[None])
    assert repair_conversations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert repair_conversations(damage(spark.createDataFrame([], SCHEMA))).collect() == []
    long = "w " * 300_000 + "end."
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t} {long if t == 3 else 'fine.'}") for t in range(3000)]
    rows[2000:2003] = [(1, t, "user", f"{t}.") for t in range(2000, 2003)]
    clash = spark.createDataFrame(rows, SCHEMA).withColumn("audit", F.lit(1)).withColumn("kind", F.lit("x")).withColumn("copy", F.lit(0))
    row = repair_conversations(clash).first()
    assert (row.cost, row.illegal, row.truncated) == (3, 2, 0) and row.audit == "K" * 2001 + "R" + "K" * 998
    assert damage(clash).columns == ["conv_id", "turn", "role", "text", "gone"]
