"""Registered queries of this subpackage: one thin ``opN_<name>`` per operator, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from . import (
    chat_format,
    collocations,
    conversation_repair,
    decontaminate,
    hash_forest,
    html_text,
    jaccard_join,
    merge_dropout,
    pu_classifier,
    quality_rules,
    substring_dedup,
    token_files,
    url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning verdict of every document."""
    return quality_rules.apply_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_words_kept")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and conversation -1, formatted and read back."""
    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    # the planted conversation: two rows, made from literals by Spark
    planted = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                    F.lit(said).alias("text"))
    chains = chat_format.turn_parents(table.unionByName(planted))
    out = chat_format.format_trees(chains, "conv_id", "node", "parent")
    read = out.withColumn("turns", chat_format.read_turns(F.col("formatted"))) \
        .withColumn("loss", chat_format.read_loss(F.col("formatted"), F.col("loss_spans")))
    said_all = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said_all, 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark, with the item."""
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_pu_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the marks outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    marks = _table(spark, sf_dir, "labels").where(~pu_classifier.held_out(F.col("doc_id")))
    model = pu_classifier.train(docs, marks)
    scored = docs.select("doc_id", pu_classifier.held_out(F.col("doc_id")).alias("held_out"),
                         pu_classifier.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= pu_classifier.THRESHOLD).cast("int"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page URL; listed are the pages that some URL reaches with an affiliate mark (``ref=``)."""
    pages = _table(spark, sf_dir, "pages")
    listed = pages.where(F.rlike("url", F.lit(r"[?&]ref="))).select("url")
    return url_filter.filter_urls(pages, listed)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 35-word window found elsewhere too, removed."""
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), with_text=False) \
        .select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at a Jaccard similarity of 0.9 on three-word shingles."""
    return jaccard_join.similar_groups(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to Arrow files and read back."""
    docs = _table(spark, sf_dir, "documents")
    folder = work_dir(spark, "token-files")
    files = token_files.write_tokens(docs, folder, tokenizer_file("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, folder, files, docs.schema["doc_id"].dataType.simpleString())


def op10_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with merge-dropout and decoded again."""
    return merge_dropout.encode_documents(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"),
                                          seed=20)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of every language."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th vector."""
    return hash_forest.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by rule, with its faults and the cheapest repair."""
    out = conversation_repair.repair(conversation_repair.damage(_table(spark, sf_dir, "conversations")))
    return out.withColumnsRenamed({"conv": "conv_id", "sha": "repaired_sha256"})


_W = r"[^\x20\x09-\x0D]+"


def _sql_op1() -> str:
    q = quality_rules
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    n_line = f"len(regexp_extract_all(ln, '{_W}'))"
    times = lambda part: f"(length(ln) - length(replace(ln, {quote(part)}, ''))) / {len(part)}.0"
    fails = " OR ".join((
        f"({n_line} < 4 AND right(trim(ln, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1)"
        f" NOT IN ({', '.join(map(quote, q.CLOSING))}))",
        f"({' + '.join(map(times, q.BARS))}) >= 2",
        *(f"contains(lower(ln), {quote(x)})" for x in q.BOILERPLATE),
        f"({' + '.join(map(times, q.MARKS))}) * 10 > {n_line} * 3",
        f"{times('!!')} * 2 > {n_line}",
        f"({n_line} >= 4 AND upper(ln) = ln AND lower(ln) <> ln)"))
    k = q.WINDOW
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_W}') AS ws, string_split(t, chr(10)) AS lns FROM d),
win AS (SELECT r, i, array_to_string(ws[i:i + {k - 1}], ' ') AS s
        FROM (SELECT r, ws, unnest(range(1, len(ws) - {k - 2})) AS i FROM w WHERE len(ws) >= {k})),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + {k})) AS j FROM dup) GROUP BY r),
c AS (
  SELECT doc_id, w.r, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    len(list_filter(lns, lambda ln: regexp_matches(ln, '{_W}')))
      - len(list_distinct(list_filter(lns, lambda ln: regexp_matches(ln, '{_W}')))) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words,
    coalesce(list_sum(list_transform(list_filter(lns, lambda ln: {n_line} = 0 OR NOT ({fails})), lambda ln: {n_line})), 0)
      AS n_words_kept
  FROM w LEFT JOIN rep ON rep.r = w.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words_kept,
  (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PCT} * n_words) AS base_failed,
  NOT (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PCT} * n_words)
    AND n_words - n_words_kept <= {q.MAX_LOST} * n_words AS kept
FROM c"""


def _sql_op2() -> str:
    esc = r"regexp_replace({}, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')"
    marks = len(chat_format.OPEN + chat_format.MID + chat_format.CLOSE)
    return f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({marks} + length({esc.format("role")}) + length({esc.format("text")})) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id"""


def _sql_op6() -> str:
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1]) - len(r[2]))
    fits = [(v, h + p, f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))") for v, h, p in rules]
    case = lambda k, other: "CASE " + " ".join(f"WHEN {x[2]} THEN '{x[k]}'" for x in fits) + f" ELSE {other} END"
    return f"""
WITH p AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(url, '{url_filter.PARTS}', 1), '{url_filter.UPPER}',
      '{url_filter.LOWER}'), '') AS host, coalesce(regexp_extract(url, '{url_filter.PARTS}', 2), '') AS path FROM pages),
k AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\\.', '')
  || regexp_replace(regexp_replace(path, '\\.html$', ''), '/+$', '') END AS key FROM p),
l AS (SELECT DISTINCT key FROM k WHERE regexp_matches(url, '[?&]ref=') AND key IS NOT NULL),
j AS (SELECT k.*, l.key IS NOT NULL AS listed FROM k LEFT JOIN l ON k.key = l.key)
SELECT page_id, host, path, {case(1, "NULL")} AS rule,
  {case(0, "CASE WHEN listed THEN 'block' ELSE 'allow' END")} AS verdict, listed FROM j"""


def _sql_op3() -> str:
    k = substring_dedup.WINDOW
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '{_W}') AS ws FROM documents),
win AS (SELECT r, i, array_to_string(ws[i:i + {k - 1}], ' ') AS s
        FROM (SELECT r, ws, unnest(range(1, len(ws) - {k - 2})) AS i FROM d WHERE len(ws) >= {k})),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {k})) AS j FROM rep),
w AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS j FROM d),
kept AS (SELECT w.r, string_agg(w.w, ' ' ORDER BY w.j) AS t, count(*) AS n
         FROM w LEFT JOIN gone ON gone.r = w.r AND gone.j = w.j WHERE gone.j IS NULL GROUP BY w.r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept ON kept.r = d.r"""


def _sql_op8() -> str:
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '{_W}') AS ws FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) END AS g FROM d),
t AS (SELECT r, unnest(g) AS tok FROM s),
n AS (SELECT r, len(g) AS n FROM s),
i AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM t a JOIN t b ON a.tok = b.tok AND a.r < b.r GROUP BY a.r, b.r),
e AS (SELECT x, y FROM i JOIN n p ON p.r = x JOIN n q ON q.r = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
ties AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT r AS x, r AS y FROM s UNION SELECT reach.x, ties.y FROM reach JOIN ties ON reach.y = ties.x)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, m.component_id
FROM s JOIN (SELECT reach.x, min(o.doc_id) AS component_id FROM reach JOIN s o ON o.r = reach.y GROUP BY reach.x) m ON m.x = s.r"""


def _sql_op11() -> str:
    c = collocations
    return f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, {c.LONGEST + 1})) AS m) WHERE len(ws) >= m),
f AS (SELECT lang, m, phrase, count(*) AS n FROM g GROUP BY ALL),
b AS (SELECT lang, m, phrase, n, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND n >= {c.LEAST}),
k AS (SELECT *, array_to_string(ws[1:k], ' ') AS x, array_to_string(ws[k + 1:], ' ') AS y
  FROM b, (SELECT unnest(range(1, {c.LONGEST})) AS k) WHERE k < m),
s AS (SELECT k.lang, k.m, k.phrase, k.n AS a, min({{'score': CAST({c.SCALE}::HUGEINT * k.n // (l.n + r.n) AS BIGINT), 'k': k.k,
    'l': l.n, 'r': r.n}}) AS cut
  FROM k JOIN f l ON l.lang = k.lang AND l.phrase = k.x JOIN f r ON r.lang = k.lang AND r.phrase = k.y GROUP BY ALL),
held AS (SELECT lang, part, max(n) AS n FROM (
    SELECT lang, n, unnest([array_to_string(ws[1:m - 1], ' '), array_to_string(ws[2:], ' ')]) AS part FROM b WHERE m > 2)
  GROUP BY ALL),
o AS (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY cut.score DESC, a DESC, phrase) AS rank
  FROM s LEFT JOIN held ON held.lang = s.lang AND held.part = s.phrase
  WHERE held.n IS NULL OR 100 * held.n < {c.SHARE} * a)
SELECT o.lang, rank, phrase, a, cut.l AS l, cut.r AS r, CAST(t.n AS BIGINT) AS n, cut.score AS score
FROM o JOIN (SELECT lang, sum(n) AS n FROM f WHERE m = 1 GROUP BY lang) t ON t.lang = o.lang WHERE rank <= {c.TOP}"""


def _sql_op13() -> str:
    c = conversation_repair
    # CRC-32 bit by bit: a byte enters at the first of eight steps
    crc = ("xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(k, ''), "
           "lambda x: [ascii(x), 0, 0, 0, 0, 0, 0, 0]))), lambda r, b: "
           "xor(xor(r, b) >> 1, CASE WHEN xor(r, b) % 2 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)")
    space = "\\x20\\x09-\\x0D"
    way = lambda w, ch, line, f, ok="true": (
        f"{{'c': {f}.c + {w} + CASE WHEN {ok} THEN 0 ELSE 1000000000 END, 'a': '{ch}' || {f}.a, 'b': {line} || {f}.b}}")
    line = lambda role: f"{role} || ':' || text || chr(10)"
    put = lambda role, f: way(c.INSERT, "I", f"'{role}:' || chr(10)", f)
    stay = f"NOT gone AND init = '{{}}'"
    late = f"CASE WHEN cut THEN {c.UNFINISHED} ELSE 0 END"

    def base(f: str, role: str, to: str, *kept: tuple) -> str:
        ways = [way(c.DELETE, "D", "''", f), way(f"{c.RENAME} + {late}", "R", line(f"'{role}'"), to, "NOT gone"),
                *(way(late, "K", line("role"), g, stay.format(x)) for x, g in kept)]
        return f"list_min([{', '.join(ways)}])"
    return f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT conv_id, turn, role, text, {crc} % 20 AS kind FROM k),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h, (SELECT unnest([1, 2]) AS copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
e AS (SELECT *, regexp_extract(text, '(?s)([^{space}])[{space}]*\\z', 1) AS bare, left(role, 1) AS init,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS was FROM o),
r AS (SELECT *, bare = '' OR again AS gone, NOT again AND bare NOT IN ('', '.', '!', '?') AS cut FROM e),
s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (bare = '') AS blank, count(*) FILTER (bare <> '' AND again) AS duplicate,
    count(*) FILTER (cut) AS truncated, count(*) FILTER (was || init NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM r GROUP BY conv_id),
f AS (
  SELECT conv_id, n AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 'b': ''}} AS f0,
    {{'c': CAST({2 * c.INSERT} AS BIGINT), 'a': 'II', 'b': 'user:' || chr(10) || 'assistant:' || chr(10)}} AS fs,
    {{'c': CAST({c.INSERT} AS BIGINT), 'a': 'I', 'b': 'assistant:' || chr(10)}} AS fu,
    {{'c': CAST(0 AS BIGINT), 'a': '', 'b': ''}} AS fa FROM s
  UNION ALL
  SELECT conv_id, i, list_min([b0, {put('user', 'fu')}]), list_min([bs, {put('user', 'fu')}]), fu, fa FROM (
    SELECT conv_id, i, b0, bs, list_min([bu, {put('assistant', 'ba')}]) AS fu, list_min([ba, {put('user', 'bu')}]) AS fa
    FROM (
      SELECT f.conv_id, f.i - 1 AS i, {base('f0', 'user', 'fu', ('s', 'fs'), ('u', 'fu'))} AS b0,
        {base('fs', 'user', 'fu', ('u', 'fu'))} AS bs, {base('fu', 'assistant', 'fa', ('a', 'fa'))} AS bu,
        {base('fa', 'user', 'fu', ('u', 'fu'))} AS ba
      FROM f JOIN r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.i = f.i)))
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(f0.c, 0) AS cost, coalesce(f0.a, '') AS audit,
  sha256(coalesce(left(f0.b, -1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM a.conv_id AND f.i = 0"""


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_chat_format, op3_substring_dedup, op4_decontaminate,
                                op5_pu_classifier, op6_url_filter, op7_token_files, op8_jaccard_join, op9_html_text,
                                op10_merge_dropout, op11_collocations, op12_hash_forest,
                                op13_conversation_repair)}


def queries():
    """Query functions by registered name."""
    return dict(QUERIES)


def oracle_sql():
    """DuckDB SQL by registered name, for the queries that SQL can express."""
    return {"op1_quality_rules": _sql_op1(), "op2_chat_format": _sql_op2(), "op3_substring_dedup": _sql_op3(),
            "op6_url_filter": _sql_op6(), "op8_jaccard_join": _sql_op8(),
            "op11_collocations": _sql_op11(), "op13_conversation_repair": _sql_op13()}
