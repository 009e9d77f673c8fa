"""Registered corpus queries against their SQL, and brute-force versions of those that SQL cannot express."""

import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from regflat.llm import decontaminate, html_text, merge_dropout, pu_classifier, queries, token_files
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "documents pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_registered():
    names = E.queries()
    assert "pipeline" in names
    assert [n for n in range(1, 14) if not any(k.startswith(f"op{n}_") for k in names)] == []


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(queries.oracle_sql()[name])
    columns, expected = [d[0] for d in res.description], res.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert len(rows) == len(expected) > 0
    assert digest(df.columns, rows) == digest(columns, expected)


def _bm25(query, items, share):
    """All items whose score for a query reaches ``share`` of their own, from the formula."""
    k1, b = decontaminate.K1, decontaminate.B
    n, avg = len(items), np.mean([len(x) for x in items])
    df = {}
    for x in items:
        for w in set(x):
            df[w] = df.get(w, 0) + 1

    def score(words, x):
        out = 0.0
        for w in set(words):
            tf = x.count(w)
            if tf:
                out += np.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(x) / avg))
        return out

    return {i: score(query, x) / score(x, x) for i, x in enumerate(items) if score(query, x) >= share * score(x, x) - 1e-9}


def test_decontaminate_brute_force(spark, con):
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    bench = con.execute("SELECT item_id, text FROM benchmark ORDER BY item_id, text").fetchall()
    items = [WORD.findall((t or "").lower()) for _, t in bench]
    half = max(decontaminate.LEAST, max(map(len, items)))
    expected = set()
    for d, text in docs:
        words = WORD.findall((text or "").lower())
        for start in range(0, max(1, len(words) - half), half):
            window = words[start:start + 2 * half]
            have = {tuple(window[i:i + 5]) for i in range(len(window) - 4)}
            for i in _bm25(window, items, decontaminate.SHARE):
                x = items[i]
                cut = len(x) - max(5, len(x) // 4)
                asked = {tuple(x[j:j + 5]) for j in range(max(cut, 5) - 4)}
                told = set(x[cut:])
                if len(asked & have) >= 0.8 * len(asked) and len(told & set(window)) >= 0.8 * len(told):
                    expected.add((d, bench[i][0]))
    found = {(r.doc_id, r.item_id) for r in queries.op4_decontaminate(spark, SF).collect()}
    assert found == expected and found


def test_decontaminate_shards_score_as_one_index(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    one = decontaminate.matches(docs, bench).collect()
    many = decontaminate.matches(docs, bench, shard=-(-bench.count() // 3)).collect()
    by = [{(r.doc_id, r.item_id): (r.score, r.question_overlap, r.answer_overlap) for r in x} for x in (one, many)]
    assert len(one) == len(many) > 0 and by[0].keys() == by[1].keys()
    assert all(by[1][k] == pytest.approx(v) for k, v in by[0].items())


def test_block_max_retrieval_equals_full_scoring():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(120)]
    items = [" ".join(rng.choice(vocabulary, rng.integers(5, 25))) for _ in range(70)]
    index = decontaminate.Index(items, block=8)
    split = [x.split() for x in items]
    for k in range(40):
        words = list(rng.choice(vocabulary, 60)) + split[k]
        h, _ = decontaminate._hash_texts([" ".join(words)])
        _, term = index.lookup(h)
        term = np.unique(term)
        _, item, score = index.retrieve(np.zeros(len(term), np.int64), term, 1)
        got = {int(index.order[i]): s * decontaminate.SHARE for i, s in zip(item, score)}
        want = _bm25(words, split, decontaminate.SHARE)
        assert set(got) == set(want)
        assert all(abs(got[i] - want[i]) < 1e-6 for i in want)


def test_classifier_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    both = queries.op5_pu_classifier(spark, sf).join(marks, "doc_id").where("held_out")
    rows = both.select("quality", "predicted").collect()
    assert len(rows) > 50
    assert np.mean([r.quality == r.predicted for r in rows]) > 0.95


def test_classifier_ignores_the_held_out_fold(spark):
    marks = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    seen = marks.where(~pu_classifier.held_out(F.col("doc_id")))
    assert {r.doc_id for r in seen.collect()} == {i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_token_files_equal_direct_encoding(spark, con):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    start, expected = 0, []
    for d, text in con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        expected.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    rows = queries.op7_token_files(spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == expected


def test_tokens_of_control_strings_and_two_generations(monkeypatch):
    """The library's defaults hold for control strings; what a worker forgets and learns again stays the same."""
    from tokenizers import Tokenizer

    path = queries.tokenizer_file("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    monkeypatch.setattr(token_files, "CACHE", 40)
    monkeypatch.setattr(token_files, "GROUP", 7)
    encoder = token_files.Encoder(path)
    rng = np.random.default_rng(3)
    for k in range(30):
        texts = [" ".join(f"wo{x}rd{'é' * (x % 3)}\n"[:rng.integers(1, 9)] for x in rng.integers(0, 90, 25)) for _ in range(5)]
        texts += ["a <|endoftext|> b<|endoftext|>c", "", "<|endoftext|>", "a\n b  c \n", "\n"]
        got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encoder.units) <= 40 + 150


def test_pages_of_the_given_template(spark, con):
    import html

    expected = {}
    for p, page in con.execute("SELECT page_id, html FROM pages").fetchall():
        article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article))
        expected[p] = "\n\n".join(x for x in parts if x)
    rows = queries.op9_html_text(spark, SF).collect()
    assert {r.page_id: r.text for r in rows} == expected
    assert all(r.n_chars == len(r.text) for r in rows)


def test_minimum_cut_is_minimal():
    """Against all labellings of small graphs: least cost, and of those the one with most content."""
    rng = np.random.default_rng(3)
    for _ in range(150):
        n = int(rng.integers(1, 8))
        content = [float(x) for x in rng.integers(0, 6, n)]
        other = [float(x) for x in rng.integers(0, 6, n)]
        edges = [(int(a), int(b), float(w)) for a, b, w in zip(rng.integers(0, n, n), rng.integers(0, n, n), rng.integers(1, 5, n))]

        def cost(label):
            out = sum(other[i] if label[i] else content[i] for i in range(n))
            return out + sum(w for a, b, w in edges if label[a] != label[b])

        best = min((cost(x), -sum(x)) for x in ([bool(k >> i & 1) for i in range(n)] for k in range(2 ** n)))
        got = html_text.minimum_cut(content, other, edges)
        assert abs(cost(got) - best[0]) < 1e-9


def _naive(codec, unit, variant):
    """Merge-dropout without an agenda: look through all pairs for the best candidate not yet judged."""
    parts, judged, key = [(i, i + 1) for i in range(len(unit))], set(), codec.key(unit, variant)
    while True:
        found = [(codec.rank[unit[a[0]:b[1]]], a, b) for a, b in zip(parts, parts[1:])
                 if unit[a[0]:b[1]] in codec.rank and (a, b) not in judged]
        if not found:
            break
        _, a, b = min(found)
        judged.add((a, b))
        if codec.skip_below and codec.skipped(key, a[0], b[1]):
            continue
        i = parts.index(a)
        parts[i:i + 2] = [(a[0], b[1])]
    out = []
    for a, b in parts:
        piece = unit[a:b]
        out += [codec.ids[piece]] if piece in codec.ids else [codec.bytes[x] for x in piece.encode()]
    return out


def test_merge_dropout_brute_force(con):
    import sentencepiece

    model = queries.tokenizer_file("piece_bpe_32k.model")
    texts = [t for (t,) in con.execute("SELECT text FROM documents WHERE text IS NOT NULL ORDER BY doc_id LIMIT 40").fetchall()]
    for seed, dropout in ((0, 0.0), (7, 0.1), (7, 0.5)):
        codec = merge_dropout.Codec(model, seed, dropout, 3)
        for i, unit in enumerate({w for t in texts for w in merge_dropout._units(" " + t.split("\n")[0])}):
            assert codec.segment(unit, i % 3) == _naive(codec, unit, i % 3)
    plain, own = sentencepiece.SentencePieceProcessor(model_file=model), merge_dropout.Codec(model, 0, 0.0, 1)
    for t in texts:
        t = " ".join(t.split())
        assert own.encode(t).tolist() == plain.encode(t)


def test_merge_dropout_varies_and_is_lossless():
    codec = merge_dropout.Codec(queries.tokenizer_file("piece_bpe_32k.model"), 3, 0.3, 4)
    odd = ["", " ", "  a  b ", "x\n\ny ▁c ▁▁ \n d", "\x00日本語 é\t🙂", "▁", "\n", "a" * 5000, "word " * 3000, "  \x85 ﻿"]
    for t in odd:
        assert codec.decode(codec.encode(t, "k")).decode() == t
    t = "The same sentence is cut in other ways for other documents"
    assert len({tuple(codec.encode(t, str(i)).tolist()) for i in range(20)}) > 3
    assert codec.encode(t, "1").tolist() == merge_dropout.Codec(queries.tokenizer_file("piece_bpe_32k.model"), 3, 0.3, 4) \
        .encode(t, "1").tolist()


def test_merge_dropout_decides_anew_at_each_occurrence():
    codec = merge_dropout.Codec(queries.tokenizer_file("piece_bpe_32k.model"), 3, 0.3)
    # one word at many places of a document, and one text in many documents
    word, n = "▁responsibilities", 300
    cuts = [tuple(codec.segment(word, codec.occurrence("d", len(word) * i))) for i in range(n)]
    assert codec.encode(" ".join([word[1:]] * n), "d").tolist() == [x for cut in cuts for x in cut]
    assert len(set(cuts)) > 20
    text = "These responsibilities are understood everywhere in the organisation"
    ids, at = codec.encode_all([text] * 3000, [str(i) for i in range(3000)])
    assert len({ids[lo:hi].tobytes() for lo, hi in zip(at, at[1:])}) > 2000
    # the first candidate is skipped at the share of occurrences that was asked for
    _, at = codec.encode_all(["t"] * 20_000, [str(i) for i in range(20_000)])
    assert abs(np.mean(np.diff(at) == 2) - 0.3) < 0.02


def test_merge_dropout_texts_together():
    """Texts encoded together, unit by unit and each by itself give the same ids."""
    codec = merge_dropout.Codec(queries.tokenizer_file("piece_bpe_32k.model"), 5, 0.2)
    texts = ["", "a  b ", "x\n\ny ▁c ▁▁ \n d", "日本語 é\t🙂 word", "", "b" * 90 + " " + "the end " * 40]
    ids, at = codec.encode_all(texts, [str(i) for i in range(len(texts))])
    for i, t in enumerate(texts):
        got = ids[at[i]:at[i + 1]]
        assert got.tolist() == codec.encode(t, str(i)).tolist() and codec.decode(got).decode() == t
    units = merge_dropout._units(" " + texts[5])
    places = np.cumsum([0, *map(len, units)])
    assert ids[at[5]:].tolist() == [x for u, p in zip(units, places) for x in codec.segment(u, codec.occurrence("5", int(p)))]


def test_merge_dropout_query_returns_the_ids(spark):
    codec = merge_dropout.Codec(queries.tokenizer_file("piece_bpe_32k.model"), 20)
    rows = queries.op10_merge_dropout(spark, SF).limit(5).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows and all(codec.decode(np.array(r.ids, np.int32)).decode() == texts[r.doc_id] for r in rows)
    assert all(r.ids == codec.encode(texts[r.doc_id], str(r.doc_id)).tolist() for r in rows)
