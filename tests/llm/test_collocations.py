"""Collocations against plain counting: bounds, levels and text cuts must not change the result."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regflat.llm import collocations as co

FOLD = {i: i + 32 for i in range(65, 91)}


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD))]


def brute(rows, least, top, share=80):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            n[lang] += len(ws)
            f.update((lang, tuple(ws[i:i + m])) for m in range(1, 5) for i in range(len(ws) - m + 1))
    cand = {q: a for q, a in f.items() if len(q[1]) > 1 and a >= least}
    out = []
    for (lang, q), a in cand.items():
        longer = [b for (o, p), b in cand.items()
                  if o == lang and len(p) > len(q) and any(p[i:i + len(q)] == q for i in range(len(p) - len(q) + 1))]
        if any(100 * b >= share * a for b in longer):
            continue
        score, _, left, right = min((2_000_000 * a // (f[lang, q[:k]] + f[lang, q[k:]]), k, f[lang, q[:k]], f[lang, q[k:]])
                                    for k in range(1, len(q)))
        out.append((lang, -score, -a, " ".join(q).encode(), left, right))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return ranked


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


def made(seed, n=60):
    rng = np.random.default_rng(seed)
    words = ["the", "of", "The", "Été", "x y", "a", "b", "c", "d", "New", "York", "City", "'", "=", "\U0001f600"]
    share = np.arange(len(words), 0, -1) ** 1.5
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(int(rng.integers(0, 60))):
            if rng.random() < .15:
                text += "new york city hall" + ". "[rng.integers(2)]
            text += words[rng.choice(len(words), p=share / share.sum())] + [" ", " ", " \t", ". ", "\n", ",", ";x "][rng.integers(7)]
        rows.append(([None, "en", "en", "de", "und"][rng.integers(5)], text if rng.random() > .05 else None))
    return rows + [("fr", ""), ("fr", " . \n"), ("xx", "one"), ("en", rows[0][1]), ("en", rows[0][1])]


@pytest.mark.parametrize("least,top,wider", [(2, 5, (1, 3)), (3, 2000, ()), (2, 12, (2, 16)), (5, 1, (1,))])
def test_collocations_equal_counting(spark, least, top, wider):
    rows = made(least + top)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for c in ("n", "h", "w1", "a", "word", "toks"):
        df = df.withColumn(c, F.lit("clash"))
    assert found(co.collocations(df, least=least, top=top, wider=wider)) == brute(rows, least, top)


def test_full_filters_change_nothing(spark, monkeypatch):
    rows = made(77, 30)
    df = spark.createDataFrame(rows, "lang string, text string")
    true = np.full(co.SLOTS, 2**64 - 1, np.uint64)
    monkeypatch.setattr(co, "_bloom", lambda phrases, m: spark.sparkContext.broadcast(true))
    assert found(co.collocations(df, least=2, top=9, wider=(1,))) == brute(rows, 2, 9)


def test_nothing(spark):
    assert co.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert co.collocations(spark.createDataFrame([("en", None), ("en", "a b")], "lang string, text string")).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("aB \t.\néx,", max_size=40), max_size=6), st.integers(1, 30))
def test_tokens_of_cut_texts(items, size):
    """Cuts fall between pieces: the pieces are those of the whole texts."""
    got = []
    for data, offsets in co._slices(pa.array(items, pa.string()), size):
        toks, h, start, end = co.tokens(data, offsets)
        low = co._LOWER[data].tobytes()
        names = dict(zip(h.tolist(), (low[a:b].decode() for a, b in zip(start, end))))
        got += [[names[x] for x in p.tolist() if x] for p in np.split(toks, np.flatnonzero(toks == 0) + 1) if len(p)]
    assert [p for p in got if p] == [p for t in items for p in pieces(t) if p]
