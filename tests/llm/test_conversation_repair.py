"""Conversation repair against a plain dynamic program over strings, in whole and cut into segments."""

import hashlib
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regflat.llm import conversation_repair as cr

OPS = {"s": "s", "u": "u", "a": "a"}


def brute(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of rows (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+", "", text)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                      "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:]))
    go = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        ways = []
        if i == len(rows):
            if state in ("", "a"):
                ways.append((0, "", ()))
        else:
            _, role, text = rows[i]
            ways.append(_add(4, "D", (), best(i + 1, state, 0)))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 if faults[i] == "truncated" else 0
                if role[:1] in go[state]:
                    ways.append(_add(extra, "K", (f"{role}:{text}",), best(i + 1, role[:1], 0)))
                for name in ("user", "assistant"):
                    if name[0] in go[state]:
                        ways.append(_add(3 + extra, "R", (f"{name}:{text}",), best(i + 1, name[0], 0)))
        if inserted < 3:
            for name in ("user", "assistant"):
                if name[0] in go[state]:
                    ways.append(_add(3, "I", (f"{name}:",), best(i, name[0], inserted + 1)))
        return min(ways) if ways else (10**9, "", ())

    def _add(w, ch, lines, rest):
        return w + rest[0], ch + rest[1], lines + rest[2]

    cost, audit, lines = best(0, "", 0)
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)


def damaged(rows):
    out = []
    show = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        role, text = show(role), show(text)
        k = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        role = "user" if k == 4 else role
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return out


def expected(rows):
    after = damaged(rows)
    return {c: brute([r[1:] for r in after if r[0] == c]) for c in {r[0] for r in rows}}


def found(df):
    return {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.sha) for r in df.collect()}


def _rows(seed, n_conv, most):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n_conv):
        for t in range(int(rng.integers(0, most))):
            turn = None if rng.random() < .05 else int(t + rng.integers(0, 2))
            role = [None, "system", "user", "assistant", "tool", "", "user", "assistant"][rng.integers(8)]
            text = [None, "", " \t\n", "ok.", "ok", "why?", f"text {t}.", f"text {t}", "é ", "\U0001f600 !"][rng.integers(10)]
            rows.append((c if rng.random() > .02 else None, turn, role, text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("segment,size,parts", [(4096, 1 << 22, 3), (3, 1 << 22, 7), (1, 1, 16), (5, 40, 2)])
def test_repair_equals_brute_force(spark, segment, size, parts):
    rows = _rows(segment, 60, 14)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("pid", F.lit("clash")).withColumn("conv", F.lit(1))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        out = cr.repair(cr.damage(df), segment, size).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    got = {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.sha) for r in out}
    assert len(out) == len(got) and got == expected(rows)


def test_one_hot_conversation_over_many_partitions(spark):
    rows = [(1, t, ("user", "assistant", "user")[t % 3], f"text {t % 50}." if t % 7 else "cut") for t in range(3000)]
    rows += [(c, 0, "user", "hello.") for c in range(2, 40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    got = found(cr.repair(cr.damage(df), 64))
    want = expected([r for r in rows if r[0] != 1])
    assert {k: v for k, v in got.items() if k != 1} == want
    # the brute force recurses too deep for the long one: cost and audit by the single steps of a plain loop
    assert got[1] == found(cr.repair(cr.damage(df.coalesce(1)), 10**6))[1]


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.repair(cr.damage(empty)).collect() == []
    # a conversation whose rows are all dropped
    gone = [(c, 0, "user", "x.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = found(cr.repair(cr.damage(spark.createDataFrame(gone, SCHEMA))))
    assert set(got.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())} and len(got) == len(gone)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(range(cr.SYMBOLS)), max_size=17))
def test_blocks_equal_single_steps(symbols):
    t = cr.tables()
    raw = bytes(symbols)
    for last in range(len(t.vector)):
        v, cost = last, 0
        between = [v]
        for x in reversed(symbols):
            cost += t.add[v, x]
            v = t.step[v, x]
            between.append(v)
        after, total = cr.vectors_between(raw, last)
        assert total == cost and after == between[::-1][1:] + [v]
        before, adds, states = cr.transfer(raw)
        assert before[last] == v and adds[last] == cost
        for s in range(4):
            now = s
            for x, w in zip(symbols, after):
                now = t.edits[w][x][now][2]
            assert states[last, s] == now


def test_vectors_are_few():
    t = cr.tables()
    assert len(t.vector) < 100 and t.vector.max() <= 13
