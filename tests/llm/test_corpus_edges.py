"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from regflat.llm import (
    chat_format,
    components,
    decontaminate,
    html_text,
    jaccard_join,
    merge_dropout,
    pu_classifier,
    quality_rules,
    queries,
    substring_dedup,
    token_files,
    url_filter,
    words,
)
from regflat.session import work_dir

LONG = " ".join(f"w{i}" for i in range(30_000))
TEXTS = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "A b c d e f."), (5, "A b c d e f."), (6, "A b c d e f."),
         (None, "null id text here."), (None, None), (7, LONG), (8, LONG + " end")]
CLASH = "n_words u sig key group id place mark leads score label h _u _t".split()


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    for c in CLASH:
        df = df.withColumn(c, F.lit("clash"))
    return df


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_quality_rules_edges(docs):
    rows = quality_rules.apply_rules(docs).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert (r.n_words, r.base_failed, r.kept) == (0, True, False)
        if r.doc_id == 7:
            assert r.n_words == 30_000 and not r.base_failed
    assert quality_rules.apply_rules(docs.limit(0)).count() == 0


def _repeated(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    return len({j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)})


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), min_size=1, max_size=8))
def test_repeated_words_property(spark, texts):
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_repeat_words for r in got} == {i: _repeated(t) for i, t in rows}


def test_line_rules(spark):
    text = "Home | News | About | More\nThis is a sentence that stays, as it should.\nClick here to read on now.\nBUY NOW OR NEVER\nmenu"
    r = quality_rules.apply_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.clean_text == "This is a sentence that stays, as it should."


def test_chat_trees(spark):
    rows = [("t", 1, None, "user", "q", 1.0), ("t", 2, 1, "assistant", "a </s> b", 5.0), ("t", 3, 1, "assistant", "c", 1.0),
            ("t", 4, 3, "user", "[INST] <\\s>", 9.0), (None, 1, None, None, None, None), ("t", 2, 1, "assistant", "a </s> b", 5.0),
            ("u", 1, 1, "user", "own parent", None), ("v", 1, 9, "user", "missing parent", 0.0), ("w", 1, 2, "user", "loop", 0.0),
            ("w", 2, 1, "user", "loop", 0.0)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    out = chat_format.format_trees(df.withColumn("leaf", F.lit(0)), "tree", "node", "parent", score_col="score", top_k=2)
    read = out.withColumn("turns", chat_format.read_turns(F.col("formatted"))) \
        .withColumn("loss", chat_format.read_loss(F.col("formatted"), F.col("loss_spans"))).collect()
    got = {(r.tree_id, r["rank"]): ([(t.role, t.text) for t in r.turns], r.loss) for r in read}
    assert got == {
        ("t", 1): ([("user", "q"), ("assistant", "c"), ("user", "[INST] <\\s>")], "c"),
        ("t", 2): ([("user", "q"), ("assistant", "a </s> b")], "a </s> b"),
        (None, 1): ([("", "")], ""), ("u", 1): ([("user", "own parent")], ""), ("v", 1): ([("user", "missing parent")], "")}
    assert chat_format.format_trees(df.limit(0), "tree", "node", "parent").count() == 0


def test_long_chain(spark):
    df = spark.range(300).select(F.lit(1).alias("tree"), F.col("id").alias("node"), (F.col("id") - 1).alias("parent"),
                                 F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    r = chat_format.format_trees(df, "tree", "node", "parent").withColumn("t", chat_format.read_turns(F.col("formatted"))).collect()
    assert len(r) == 1 and [x.text for x in r[0].t] == [str(i) for i in range(300)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="<[/s>INST]\\ a", max_size=25), min_size=1, max_size=6))
def test_escape_round_trip(texts):
    """The same patterns in Python: no control string is left, and unescaping gives the text back."""
    for t in texts:
        e = re.sub(chat_format.CONTROL, r"\1\\\2\3", t)
        assert not any(c in e for c in ("</s>", "<s>", "[INST]", "[/INST]"))
        assert re.sub(chat_format.ESCAPED, r"\1\2\3", e) == t


def _without_repeats(texts, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        out.append((len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("group", [1000, 2])
def test_substring_dedup_brute_force(spark, group):
    """Small windows over few words, so that repeats overlap, nest and touch; ``group=2`` takes the long-prefix way."""
    rng = np.random.default_rng(group)
    texts = [" ".join(rng.choice(list("abcd"), int(rng.integers(0, 60)))) for _ in range(60)]
    texts += [texts[3] + " x " + texts[4], texts[5], texts[5], None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = substring_dedup.remove_repeats(df, window=7, gram=3, group=group).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in got] == _without_repeats(texts, 7)


def test_substring_dedup_edges(docs):
    rows = substring_dedup.remove_repeats(docs).collect()
    assert len(rows) == len(TEXTS)
    by = {r.doc_id: r for r in rows}
    assert by[7].n_removed == 30_000 and by[8].n_removed == 30_000 and by[8].n_words == 30_001
    assert by[5].n_removed == 0 and by[1].n_words == 0
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


def _sets(texts, k):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        out.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    return out


def _groups(ids, sets, num, den):
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(sets)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i), ids[i]) for i in range(len(sets))]


@pytest.mark.parametrize("shingle,num,block", [(3, 90, 2_000_000), (5, 80, 2_000_000), (3, 90, 150), (1, 60, 100)])
def test_jaccard_brute_force(spark, shingle, num, block):
    """Texts changed word by word around the threshold; small blocks take the block-wise way."""
    rng = np.random.default_rng(num + block)
    texts = ["", None, "A b", "a B", "a", "a b c", "a b c d"]
    for n in (6, 12, 25, 60, 150, 400):
        base = [f"w{int(x)}" for x in rng.integers(0, 10_000, n)]
        for _ in range(9):
            t = list(base)
            for _ in range(int(rng.integers(0, max(2, n // 12)))):
                t[int(rng.integers(0, n))] = f"x{int(rng.integers(0, 1000))}"
            texts.append(" ".join(t[:len(t) - int(rng.integers(0, 2))]))
    ids = [int(x) for x in rng.permutation(len(texts))]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           jaccard_join.similar_groups(df, shingle=shingle, num=num, block=block).collect()}
    sets = _sets(texts, shingle)
    assert got == {i: (len(s), g) for i, s, g in zip(ids, sets, _groups(ids, sets, num, 100))}


def test_jaccard_keys_meet():
    """Every linked pair is a candidate: shared units reach what both sides need, and a listed key is shared."""
    rng = np.random.default_rng(11)
    for num in (90, 80):
        bands = jaccard_join.Bands(num, 100)
        for _ in range(120):
            n = int(rng.integers(5, 400))
            a = np.unique(rng.integers(1, 2**63, n).astype(np.uint64))
            drop, add = rng.integers(0, max(1, n // 10) + 1, 2)
            b = np.unique(np.concatenate([a[int(drop):], rng.integers(1, 2**63, int(add)).astype(np.uint64)]))
            inter = len(np.intersect1d(a, b))
            if 100 * inter < num * (len(a) + len(b) - inter) or np.array_equal(a, b):
                continue
            key, which, mark, need = jaccard_join.keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), bands)
            met = False
            for band in np.unique(mark >> 2):
                rows = mark >> 2 == band
                one, two = (set(zip(key[rows & (which == i)], mark[rows & (which == i)] & 1)) for i in (0, 1))
                homes = {int(i) for i in which[rows & (mark & jaccard_join.HOME > 0)]}
                if not one or not two or not homes:
                    continue
                shared = one & two
                units = sum(1 for _, near in shared if not near) + 2 * any(near for _, near in shared)
                met |= bool(shared) and all(units >= need[rows & (which == i)].max() for i in (0, 1))
            assert met


def test_jaccard_keys_travel_packed():
    """Keys leave a task as arrays, one row for each part of a cell, beside one row a text; none is lost."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(x)}" for x in rng.integers(0, 1000, 300)) for _ in range(200)] + [None, "a"]
    batch = pa.record_batch({"id": list(range(len(texts))), "text": pa.array(texts, pa.string()),
                             "u": rng.integers(-2**62, 2**62, len(texts))})
    out = pa.Table.from_batches(list(jaccard_join._index_rows(3, 80, 100, 16)(iter([batch])))).to_pylist()
    packed = [r for r in out if r["key"] is not None]
    assert len(packed) <= 32 and sorted(r["id"] for r in out if r["key"] is None) == list(range(len(texts)))
    data = "".join(t or "" for t in texts).encode()
    ends = np.cumsum([0] + [len(t or "") for t in texts])
    token, _, at = jaccard_join._sets(np.frombuffer(data, np.uint8), ends, 3)
    key, _, mark, need = jaccard_join.keys(token, at, jaccard_join.Bands(80, 100))
    assert len(key) > 1000
    got = [x for r in packed for x in zip(np.frombuffer(r["key"], np.uint64), np.frombuffer(r["mark"], np.int32),
                                          np.frombuffer(r["need"], np.int32))]
    assert sorted(got) == sorted(zip(key, mark, need))
    assert all((m & jaccard_join.HOME > 0) == (r["part"] == jaccard_join.HOMES)
               for r in packed for m in np.frombuffer(r["mark"], np.int32))


@pytest.mark.parametrize("step", [3, 40, 10_000])
def test_jaccard_company(step):
    """Rows whose key another set has too, one of them in its own band; what is held on the way is a row a key."""
    rng = np.random.default_rng(step)
    n = 2000
    key = np.where(rng.random(n) < 0.3, 7, rng.integers(0, 1500, n)).astype(np.uint64)  # one very common key
    sig = rng.integers(0, 300, n)
    # a set has one own band; its rows elsewhere are away
    mark = np.where((sig + key.astype(np.int64) // 2) % 3 > 0, jaccard_join.HOME, 0).astype(np.int32)
    need = rng.integers(0, 9, n).astype(np.int32)
    order = np.argsort(mark == 0, kind="stable")
    columns = [x[order] for x in (key, sig, mark, need)]
    got, known = [], None
    for lo in range(0, n, step):
        found, known = jaccard_join.in_company([tuple(x[lo:lo + step] for x in columns)], known, lo + step < n)
        got += zip(*found)
        assert known is None or len(known[1]) == len(set(columns[0][:lo + step][columns[2][:lo + step] > 0].tolist()))
    sets, homes = {}, set()
    for k, s, m in zip(key, sig, mark):
        sets.setdefault(k, set()).add(s)
        if m:
            homes.add(k)
    expected = {r for r in zip(key, sig, mark, need) if len(sets[r[0]]) > 1 and r[0] in homes}
    assert expected and {(k, s, m) for k, s, m, _ in got} == {(k, s, m) for k, s, m, _ in expected}
    assert len(got) <= len(key)


def test_jaccard_edges(spark, docs):
    rows = jaccard_join.similar_groups(docs).collect()
    assert len(rows) == len(TEXTS)
    assert {r.doc_id: r.component_id for r in rows if r.doc_id} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 7}
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 1, None: 2}
    assert jaccard_join.similar_groups(docs.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (300, 300), (None, 5), (70, 71), (71, 69)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 69: 69, 70: 69, 71: 69}


def test_decontaminate_edges(spark, docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (4, "a B c d e f."), (4, "a B c d e f."),
                                   (5, " ".join(f"w{i}" for i in range(200, 260)))], "item_id int, text string").withColumn("id", F.lit(0))
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect())
    assert got == Counter({(4, 3): 1, (5, 4): 4, (6, 4): 2, (7, 5): 1, (8, 5): 1})
    assert Counter((r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench, shard=2).collect()).keys() >= {(4, 3), (7, 5)}
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == {1: 1, 2: 1, 3: 1, None: 2}
    assert decontaminate.matches(docs, bench.limit(0)).count() == 0
    assert decontaminate.matches(docs.limit(0), bench).count() == 0


def test_decontaminate_folds_accented_capitals(spark):
    item = "où se trouve la forêt près de l'étang à côté du château où naît à l'été la rivière dorée émeraude"
    bench = spark.createDataFrame([(1, item), (2, item.upper())], "item_id int, text string")
    docs = spark.createDataFrame([(1, f"one two {item.upper()} three"), (2, f"one two {item} three"), (3, "one two three")],
                                 "doc_id long, text string")
    rows = decontaminate.matches(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.question_overlap, r.answer_overlap) for r in rows) == \
        [(d, i, 1.0, 1.0) for d in (1, 2) for i in (1, 2)]
    assert [tuple(r) for r in decontaminate.clean(docs, bench, shard=1).collect()] == [(3, "one two three")]


def test_classifier_edges(spark, docs):
    marks = spark.createDataFrame([(5, 1), (5, 0), (6, 1), (None, 1), (7, None), (99, 1)], "doc_id long, quality int")
    model = pu_classifier.train(docs, marks)
    rows = docs.select("doc_id", pu_classifier.score(F.col("text"), model).alias("s")).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.s <= 1 for r in rows)
    blank = pu_classifier.train(docs.limit(0), marks.limit(0))
    assert docs.select(pu_classifier.score(F.col("text"), blank).alias("s")).distinct().collect()[0].s == 0.5


def test_url_filter_edges(spark):
    urls = [(1, None), (2, "no scheme.net/x"), (3, "http://A.NET"), (4, "http://a.net/"), (5, "https://x.Example.net/en/1#f"),
            (6, "http://example.com/de/?q"), (7, "http://b.org/fr/1"), (8, "http://b.org/p.html?ref=1"), (9, "https://www.b.org/p"),
            (10, "http://notexample.com/de/"), (10, "http://notexample.com/de/"), (None, "http://h/"), (11, "")]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in
           url_filter.filter_urls(pages, pages.where("url like '%ref=%'")).collect()}
    assert got == {
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "a.net", "", None, "allow"), (4, "a.net", "/", "net/", "block"),
        (5, "x.example.net", "/en/1", "example.net/en/", "allow"), (6, "example.com", "/de/", "example.com/de/", "block"),
        (7, "b.org", "/fr/1", "org/fr/", "allow"), (8, "b.org", "/p.html", None, "block"), (9, "www.b.org", "/p", None, "block"),
        (10, "notexample.com", "/de/", None, "allow"), (None, "h", "/", None, "allow"), (11, "", "", None, "allow")}
    assert url_filter.filter_urls(pages.limit(0), pages.limit(0)).count() == 0


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(3000).select(F.concat(F.lit("u"), F.col("id")).alias("k"))
    probe = spark.range(6000).select(F.concat(F.lit("u"), F.col("id")).alias("k"), "id")
    rows = url_filter.on_list(probe, keys, "k", "k").collect()
    assert all(r["_listed"] == (r.id < 3000) for r in rows) and len(rows) == 6000


def test_only_possible_hits_meet_the_list(spark):
    """The rows that the exact join moves are those that the filter passes; a null key is none of them."""
    keys = spark.range(500).select(F.concat(F.lit("u"), F.col("id")).alias("k"))
    probe = spark.range(40000).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("u"), F.col("id"))).alias("k"), "id")
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        found = url_filter.on_list(probe, keys, "k", "k")
        rows = found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)
    assert len(rows) == 40000 and sum(r["_listed"] for r in rows) == sum(x % 3 > 0 for x in range(500))
    assert "Union" in plan
    passed = url_filter.probe(probe, keys.select(F.col("k").alias("_k")), "k").where("_possible")
    assert 333 <= passed.count() < 1500 and passed.where("k is null").count() == 0


def test_token_files_edges(spark, docs):
    folder = work_dir(spark, "test-tokens")
    files = token_files.write_tokens(docs, folder, queries.tokenizer_file("byte_bpe_50k.json"), length=64)
    rows = token_files.read_tokens(spark, folder, files, "bigint").orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
    # random access: sequence by sequence the same ids, and padding only under a false mask
    total = 0
    for f in files:
        with token_files.open_sequences(f"{folder}/part-{f['part']:05d}.arrow") as reader:
            ids = [token_files.sequence(reader, i) for i in range(f["n_sequences"])]
            assert all(len(x) == 64 for x, _ in ids)
            total += sum(int(m.sum()) for _, m in ids)
            assert all(m.all() for _, m in ids[:-1])
    assert total == sum(r.n_tokens for r in rows)
    empty = work_dir(spark, "test-tokens")
    files = token_files.write_tokens(docs.limit(0), empty, queries.tokenizer_file("byte_bpe_50k.json"))
    assert files == [] and token_files.read_tokens(spark, empty, files, "bigint").count() == 0


def test_odd_white_space_encodes_as_a_whole():
    enc = token_files.Encoder(queries.tokenizer_file("byte_bpe_50k.json"))
    texts = ["", " ", "a  b", " lead", "trail ", "a\nb c", "a \nb", "tab\t x", "x <|endoftext|> y", "l1\n\n l2 it's  9", "é ü  z"]
    for t, got in zip(texts, enc.encode(texts)):
        assert np.frombuffer(got, enc.dtype).tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids


def test_html_edges(spark):
    pages = [(1, None), (2, ""), (3, "plain words only, not a tag."), (4, "<p>a &amp; b<p>c&nbsp;d <b>e</b>f."),
             (5, "<body><nav><a href=x>Home</a></nav><main><h1>T</h1><p>Text one here.</p><div class='comments'><p>Nice!</p></div></main>"
                 "<footer>f</footer>"), (6, "<p>x</p><script>var a='<p>no</p>'"), (7, "<div " * 50), (8, "<p>" + "long words. " * 20000)]
    df = spark.createDataFrame([(i, "u", h, 0) for i, h in pages], "page_id long, url string, html string, text int")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert got[1] == got[2] == "" and got[4] == "a & b\n\nc d ef."
    assert got[5] == "T\n\nText one here." and len(got[8]) == 12 * 20000 - 1
    assert html_text.extract(df.limit(0)).count() == 0


STORY = "<p>The first paragraph of the story tells, in one sentence, what it is about.</p><p>The second one ends it, as it should.</p>"
TOLD = "The first paragraph of the story tells, in one sentence, what it is about.\n\nThe second one ends it, as it should."


@pytest.mark.parametrize("page", [
    "<head><meta charset=utf-8><title>t</title><body><article>{}</article>", "<head><meta charset=utf-8><article>{}</article>",
    "<head><link rel=x><title>t</title><script>var a</script><style>p {{}}</style></head><body><article>{}</article>",
    "<head><title><body><article>{}</article>", "<article><select>{}</article>", "<article><object data=x>{}</article>",
    "<article><svg>{}</article>", "<article><svg/>{}<svg>no</svg></article>", "<article><iframe src=x>{}</article>",
    "<article><select><option>no</select><select>{}</article>", "<article>{}</article><script>var a = '<p>no</p>'"])
def test_html_without_end_tags(page):
    assert html_text.main_text(page.format(STORY)) == TOLD


@pytest.mark.parametrize("page", [
    "<div class='site has-sidebar'><article>{}</article></div>", "<div class=no-sidebar><article>{}</article></div>",
    "<div class='content with-nav'><article>{}</article></div>", "<div class='search-page'>{}</div>", "<div class=search>{}</div>",
    "<div class='sidebar'><article>{}</article></div><p>More here.</p>", "<div id=comments><main>{}</main></div>",
    "<form id=aspnetForm><div>{}</div></form>", "<form><fieldset><article>{}</article></fieldset></form>",
    "<main><div class='widget'>{}</div></main>", "<article title='the hidden cost'>{}</article>",
    "<article class='md:block hidden lg:flex'>{}</article>", "<article data-class=ad>{}</article>",
    "<article>{}<div class=ad><p>Buy it now, as all others do.</p></div></article>", "<article>{}</article><p hidden>Not shown, this one.</p>",
    "<article>{}</article><p HIDDEN=''>Not shown, this one.</p>",
    "<article>{}<form><p>Your mail address, please.</p></form></article>", "<div class=sidebar><p>Read this too.</p></div><div>{}</div>"])
def test_html_frames_with_hints(page):
    got = html_text.main_text(page.format(STORY))
    assert got in (TOLD, TOLD + "\n\nMore here.")


def test_merge_dropout_edges(docs):
    out = merge_dropout.encode_documents(docs, queries.tokenizer_file("piece_bpe_32k.model"))
    rows = out.collect()
    assert len(rows) == len(TEXTS) and all(r.lossless for r in rows)
    assert all(r.n_pieces == len(r.ids) for r in rows)
    assert merge_dropout.encode_documents(docs.limit(0), queries.tokenizer_file("piece_bpe_32k.model")).count() == 0


def test_word_hashes():
    raw = [b"", b"one two", b" one\x0b", b"two", b"\t\n", "é one".encode()]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    h, at = words.hash_words(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert np.diff(at).tolist() == [0, 2, 1, 1, 0, 2]
    assert h[0] == h[2] == h[5] and h[1] == h[3] and len(set(h.tolist())) == 3


def test_pipeline_stages(spark):
    """Each stage's decision takes effect on planted documents."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    columns = docs.columns
    long = " ".join(f"q{i}" for i in range(90))
    shared = " ".join(f"s{i}" for i in range(55))
    own = " ".join(f"o{i}" for i in range(30))
    planted = spark.createDataFrame(
        [(-1, long), (-2, long), (-3, f"{long} tail"), (-4, f"{own} p1 {shared} p3"), (-5, f"r1 {shared} r2 r3")], "doc_id long, text string") \
        .select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    both = docs.unionByName(planted)
    once = corpus_pipeline.jaccard_dedup(spark, both, sf)
    assert once.columns == columns
    assert sorted(r.doc_id for r in once.where("doc_id < 0").collect()) == [-5, -4, -3]
    cut = corpus_pipeline.passage_dedup(spark, both, sf).where("doc_id < 0")
    assert cut.columns == columns
    assert {r.doc_id: (r.text, r.n_chars) for r in cut.collect() if r.doc_id < -3} == {-4: (f"{own} p1 p3", len(own) + 6), -5: ("r1 r2 r3", 8)}
    assert corpus_pipeline.quality_classifier(spark, both, sf).columns == columns
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    leak = planted.limit(1).withColumn("text", F.lit(f"a b c {item} d e f"))
    assert corpus_pipeline.decontamination(spark, leak, sf).count() == 0
    last = corpus_pipeline.run(spark, sf)
    assert last.where("lossless").count() == last.count() > 0


def test_units_share_the_ids_of_their_letters():
    """Letters are learned once, whatever signs stand behind them; line feeds inside a unit stay in its group."""
    enc = token_files.Encoder(queries.tokenizer_file("byte_bpe_50k.json"))
    texts = ["a wordy, wordy. wordy! (wordy) wordy", "x wordy.\nWordy wordy's, 12,5 ä.ö ... é,,", "q end.\n\nnext wordy;", "w a\nb\nc d"]
    for t, got in zip(texts, enc.encode(texts)):
        assert np.frombuffer(got, enc.dtype).tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids
    assert {",", ".", "!", ";"} <= set(enc.tails)


def test_pipeline_stages_hand_over_texts_in_small_batches(spark):
    """Batches of 10,000 whole texts took an executor and its workers over their memory."""
    spark.conf.unset(corpus_pipeline.BATCH_BYTES)
    try:
        rows = spark.createDataFrame([(i, "x" * 9_000, 9_000) for i in range(1_500)], "doc_id long, text string, n_chars long")
        corpus_pipeline.passage_dedup(spark, rows, "")

        def sizes(batches):
            for b in batches:
                yield pa.record_batch({"n": pa.array([b.nbytes], pa.int64())})

        held = [r.n for r in rows.coalesce(1).mapInArrow(sizes, "n long").collect()]
        assert len(held) > 1 and max(held) < 5 << 20
        spark.conf.set(corpus_pipeline.BATCH_BYTES, "1m")  # a setting of the caller stays
        corpus_pipeline.passage_dedup(spark, rows, "")
        assert spark.conf.get(corpus_pipeline.BATCH_BYTES) == "1m"
    finally:
        spark.conf.unset(corpus_pipeline.BATCH_BYTES)


def test_subtrees_and_chunks_of_text_are_held_a_few_at_a_time(monkeypatch):
    solved = []

    def windows(group, *rest):
        solved.append(len(group))
        return np.zeros(len(group), np.int64)

    monkeypatch.setattr(substring_dedup, "repeated_windows", windows)
    batches = (pa.record_batch({"h": pa.array([i] * 1_000, pa.int64()), "u": pa.array(range(1_000), pa.int64()),
                                "place": pa.array([0] * 1_000, pa.int32()), "before": pa.array([0] * 1_000, pa.int32()),
                                "words": pa.array([b"\0" * 8] * 1_000, pa.binary())}) for i in range(60))
    list(substring_dedup._subtree_rows(35, 16)(batches))
    assert sum(solved) == 60_000 and max(solved) <= 16_000
    slices = list(words.texts(pa.array(["a" * 1_000] * 2_000)))
    assert slices[0][0] == 0 and slices[-1][1] == 2_000
    assert max(int(at[-1] - at[0]) for _, _, _, at in slices) <= 1 << 18


def test_remembered_units_are_looked_up_not_gone_through():
    """An intersection of a set with a dictionary goes through the whole dictionary, for every 256 texts."""
    class Remembered(dict):
        def __iter__(self):
            raise AssertionError("gone through")

    path = queries.tokenizer_file("byte_bpe_50k.json")
    enc, plain = token_files.Encoder(path), token_files.Encoder(path)
    texts = ["one two three four", "five two, six"]
    plain.encode(texts)
    enc.older = Remembered(plain.units)
    assert enc.encode(texts) == plain.encode(texts)
    assert enc.units["two"] is plain.units["two"]


def test_lines_of_a_unit_share_the_ids_of_their_letters():
    """Text is cut by Arrow some MB at a time; units of several lines are learned line by line, letters without a pattern."""
    enc = token_files.Encoder(queries.tokenizer_file("byte_bpe_50k.json"))
    texts = ["x wordy.\nÖther, more", None, "x öther.\nwordy\nЖук!! wordy", "", "x more\n12 it's a\tb\n\nc 字かな한 d\u0378,", "x " * 300 + "y"]
    got = enc.encode(pa.array(texts))
    assert [np.frombuffer(x, enc.dtype).tolist() for x in got] == [
        enc.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert {"wordy", "\nwordy", "\nÖther", "öther", "\nЖук", "more"} <= set(enc.units)
    assert not any(x in u for u in enc.units if not {*u} & {*"12\t\u0378"} for x in ".,!")
    # a partition's texts are cut some MB at a time, whatever their number
    column = pa.array(["a" * 5_000] * 2_000 + [None, "b" * (9 << 20), "c"])
    ranges = list(token_files._chunks(column))
    assert [lo for lo, _ in ranges] == [0, *(hi for _, hi in ranges[:-1])] and ranges[-1][1] == len(column)
    assert len(ranges) == 4 and all(hi - lo == 1 or sum(len(x.as_py() or "") for x in column[lo:hi]) <= token_files.CHUNK for lo, hi in ranges)


def test_a_passage_that_goes_round_makes_one_row_a_text_and_window(spark):
    """Windows of common prefixes met once for each of their anchors and place: their join made rows by the hundred a text."""
    lines = [f"own{i} " * 20 + "is onhe. " * (40 + i) + f"end{i}" for i in range(4)]
    batch = pa.record_batch({"u": pa.array(range(4), pa.int64()), "text": lines,
                             "places": pa.array([list(range(20, 20 + 2 * (40 + i) - 15)) for i in range(4)], pa.list_(pa.int32()))})
    rows = pa.Table.from_batches(substring_dedup._suffix_rows(35, 16, True)([batch])).to_pylist()
    assert len({(r["h"], r["u"]) for r in rows}) == len(rows)
    for i in range(4):  # two windows that go round, the others once, each place once
        mine = [r["places"] for r in rows if r["u"] == i]
        places = sorted(x for p in mine for x in p)
        assert places == sorted(set(places)) and sorted(map(len, mine))[-2:] == [23 + i, 23 + i]
        assert all(len(p) == 1 for p in sorted(mine, key=len)[:-2])
    # the same words go whichever way a prefix takes, rows that come twice and null ids too
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)] + [(0, lines[0]), (None, "is onhe. " * 30 + "x"), (9, "is onhe. " * 10)],
                               "doc_id long, text string")
    both = [sorted(map(str, substring_dedup.remove_repeats(df, group=g).collect())) for g in (1, 20_000)]
    assert both[0] == both[1] and len(both[0]) == 7
    # both copies lose all; elsewhere what stands in no window that is met again stays
    kept = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(df, group=1).collect()}
    assert kept[1] == 2 * 41 and kept[0] == 20 + 2 * 40 + 1 and kept[None] == 60 and kept[9] == 0
