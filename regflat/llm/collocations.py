"""Phrase collocations per language by best-first branch and bound over prefixes.

A phrase of two to four words scores 2a / (l + r) at its worst cut, a, l and r being the counts of the phrase and of the
two parts; it is dropped if a phrase that holds it occurs at least 80 % as often.

Method.  Phrases grow word by word.  A prefix p that begins with word v bounds all that grow out of it: they occur at most
f(p) times and their cut after v scores at most 2 f(p) / (f(v) + f(p)); the bound never rises along a branch.  Every word
has the highest bound, so all pairs are counted first.  Then, per language, the prefixes are expanded from the highest
bound down to a level taken from the pairs' scores; with the prefixes the phrases that end in one are counted (they may
drop it).  A language is settled when its ``top``-th surviving score is no lower than the level: whatever was not
expanded scores less, so ties are complete too.  Others go on at a lower level, the last one being zero.
Only the phrase one word longer needs a look for the drop: counts never rise as phrases grow.

Scale.  Texts become rows of 64-bit word hashes once (cut at piece ends, so a long text is many small rows) in the shared
folder; each expansion is a pass over them that counts in the tasks before it shuffles.  What travels to the tasks are Bloom
filters of a fixed size (``SLOTS`` words of 64 bits): a false hit costs a count, never changes one, and a set that
outgrows them only prunes less.  Per-language work is grouping and limited windows, so one large language is no hot group.

Words are told apart by 64-bit hash, phrases by the tuple of their words' hashes (see ``words``); counts are integers and
scores decimals, so arithmetic is exact.

Defined results: a null text is empty, a null language is ``und``; repeated rows count as often as they stand; texts
without pieces count nothing; an empty table gives no rows; a language with fewer survivors returns them all; a piece
without any separator is held whole.  Other columns take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_dir
from .words import CHUNK, mix, texts

LEAST = 30
TOP = 2000
SHARE = 80  # percent of a phrase's count at which a longer one drops it
LONGEST = 4
SCALE = 2_000_000
SLOTS = 1 << 20  # 64-bit words of a Bloom filter
HELD = 1 << 18  # rows of counts that a task holds
ROW = 512  # tokens of a stored row, about: readers hold thousands of rows at once
STEP = 1 << 17  # tokens worked on at once
WIDER = (2, 16)  # levels are the scores of the pairs of these ranks, times TOP; then zero

_rng = np.random.default_rng(20251111)
_LETTER = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 0 part of a word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_JOIN = np.uint64(0xD6E8FEB86659FD93)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of some texts with 0 after every piece, then each word's hash, first and last byte (in lower case)."""
    kind = _KIND[data]
    is_word = kind == 0
    before, after = np.empty_like(is_word), np.empty_like(is_word)
    before[:1], before[1:] = False, is_word[:-1]
    after[-1:], after[:-1] = False, is_word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    after[inner - 1] = False
    start = np.flatnonzero(is_word & ~before)
    end = np.flatnonzero(is_word & ~after) + 1
    if not len(start):
        none = np.empty(0, np.uint64)
        return none, none, start, end
    size = end - start
    at = np.flatnonzero(is_word)
    powers = np.full(int(size.max()), _STEP, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    value = _LETTER[_LOWER[data[at]]] * powers[at - np.repeat(start, size)]
    h = mix(np.add.reduceat(value, np.concatenate([[0], np.cumsum(size)[:-1]])) + size.astype(np.uint64))
    h[h == 0] = 1
    seps = np.cumsum(kind == 2)
    text = np.searchsorted(inner, start, side="right")
    ends = np.ones(len(start), bool)
    ends[:-1] = (seps[start[1:]] > seps[end[:-1] - 1]) | (text[1:] != text[:-1])
    out = np.zeros(len(start) + int(ends.sum()), np.uint64)
    out[np.arange(len(start)) + np.cumsum(ends) - ends] = h
    return out, h, start, end


def _slices(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of about ``size`` bytes; a longer text is cut after separators of pieces."""
    for _, _, data, offsets in texts(column, size):
        data, offsets = data[int(offsets[0]):int(offsets[-1])], offsets.astype(np.int64) - int(offsets[0])
        lo = 0
        while len(data) - lo > 2 * size:
            hi = lo + size
            cut = np.flatnonzero(_KIND[data[lo:hi]] == 2)
            while not len(cut) and hi < len(data):
                step = data[hi:hi + size]
                cut = np.flatnonzero(_KIND[step] == 2)[:1] + hi - lo
                hi += len(step)
            if not len(cut):
                break
            hi = lo + int(cut[-1]) + 1
            inside = offsets[(offsets > lo) & (offsets < hi)]
            yield data[lo:hi], np.concatenate([[lo], inside, [hi]]) - lo
            lo = hi
        inside = offsets[(offsets > lo) & (offsets < len(data))]
        yield data[lo:], np.concatenate([[lo], inside, [len(data)]]) - lo


def _cuts(toks: np.ndarray) -> np.ndarray:
    """Places to cut tokens into rows of about ``ROW``, each after the end of a piece."""
    ends = np.flatnonzero(toks == 0) + 1
    return np.unique(ends[np.searchsorted(ends, np.arange(ROW, ends[-1], ROW))]) if ends[-1] > ROW else ends[:0]


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """The tokens of consecutive rows of one language, about ``STEP`` at once."""
    column = batch.column("toks")
    if not len(column):
        return
    _, at, body = column.buffers()
    places = np.frombuffer(at, np.int32)[column.offset:column.offset + len(column) + 1] // 8
    data = np.frombuffer(body, np.uint64, count=int(places[-1]))
    langs = batch.column("lang").to_pylist()
    lo = 0
    for k in range(1, len(langs) + 1):
        if k == len(langs) or langs[k] != langs[lo] or places[k] - places[lo] >= STEP:
            yield langs[lo], data[places[lo]:places[k]]
            lo = k


_TOKEN_SCHEMA = "lang string, toks binary, h long, n long, word string"
_TOKEN_ARROW = pa.schema([("lang", pa.string()), ("toks", pa.binary()), ("h", pa.int64()), ("n", pa.int64()),
                          ("word", pa.string())])


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of tokens, and rows of words with their counts in this task."""
    held: dict[str, list] = {}

    def words_of(lang: str) -> pa.RecordBatch:
        h, n, word = held.pop(lang)
        return pa.record_batch([pa.array([lang] * len(h)), pa.nulls(len(h), pa.binary()), pa.array(h.view(np.int64)),
                                pa.array(n), word], schema=_TOKEN_ARROW)

    for batch in batches:
        lang_of = batch.column("lang")
        for lang in lang_of.unique().to_pylist():
            column = batch.column("text").filter(pc.equal(lang_of, lang))
            for data, offsets in _slices(column):
                toks, h, start, end = tokens(data, offsets)
                if not len(h):
                    continue
                rows = [x.tobytes() for x in np.split(toks, _cuts(toks))]
                none = pa.nulls(len(rows), pa.int64())
                yield pa.record_batch([pa.array([lang] * len(rows)), pa.array(rows, pa.binary()), none, none,
                                       pa.nulls(len(rows), pa.string())], schema=_TOKEN_ARROW)
                seen, first, count = np.unique(h, return_index=True, return_counts=True)
                low = _LOWER[data].tobytes()
                if lang in held:
                    old, n, word = held[lang]
                    place = np.minimum(np.searchsorted(old, seen), len(old) - 1)
                    known = old[place] == seen
                    n[place[known]] += count[known]
                    seen, first, count = seen[~known], first[~known], count[~known]
                names = pa.array([low[a:b].decode("utf-8", "replace") for a, b in zip(start[first].tolist(), end[first].tolist())],
                                 pa.string())
                if lang in held:
                    order = np.argsort(np.concatenate([old, seen]), kind="stable")
                    held[lang] = [np.concatenate([old, seen])[order], np.concatenate([n, count])[order],
                                  pa.concat_arrays([word, names]).take(pa.array(order))]
                else:
                    held[lang] = [seen, count.astype(np.int64), names]
                if sum(len(x[0]) for x in held.values()) > HELD // 2:
                    for x in list(held):
                        yield words_of(x)
    for lang in list(held):
        yield words_of(lang)


def _seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of phrases given as their words' columns."""
    h = columns[0]
    for c in columns[1:]:
        h = mix(h * _JOIN + c)
    return h


def _bits(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot and bits of a key in a blocked Bloom filter."""
    one = np.uint64(1)
    bits = one << (key >> np.uint64(40) & np.uint64(63))
    for shift in (46, 52, 58):
        bits |= one << (key >> np.uint64(shift) & np.uint64(63))
    return (key & np.uint64(SLOTS - 1)).astype(np.int64), bits


def _has(bloom: np.ndarray, seed: np.uint64, h: np.ndarray) -> np.ndarray:
    slot, bits = _bits(mix(h ^ seed))
    return bloom[slot] & bits == bits


def _bloom(phrases: DataFrame, m: int):
    """Broadcast Bloom filter of (lang, w1 .. wm): each task's bits are joined by slot, never more than ``SLOTS`` rows."""
    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            seeds = np.array([_seed(x) for x in langs.dictionary.to_pylist()], np.uint64)
            if not batch.num_rows:
                continue
            h = _hash([batch.column(f"w{i + 1}").to_numpy().view(np.uint64) for i in range(m)])
            slot, bits = _bits(mix(h ^ seeds[langs.indices.to_numpy()]))
            order = np.argsort(slot, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], np.diff(slot[order]) != 0]))
            yield pa.record_batch({"slot": pa.array(slot[order[first]], pa.int32()),
                                   "bits": pa.array(np.bitwise_or.reduceat(bits[order], first).view(np.int64))})

    spark = phrases.sparkSession
    rows = phrases.select("lang", *(f"w{i + 1}" for i in range(m))).mapInArrow(slots, "slot int, bits long") \
        .groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(SLOTS, np.uint64)
    out[rows.column("slot").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(out)


def _merged(h: np.ndarray, words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    h = h[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[first], words[:, order[first]], np.add.reduceat(n[order], first)


def _grams(m: int, choose):
    """Counts of the phrases of m words that ``choose(seed, t, inside)`` picks, joined within the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        rows = 0

        def counted(lang: str) -> tuple:
            parts = held[lang]
            if len(parts) > 1:
                held[lang] = parts = [_merged(*(np.concatenate([p[i] for p in parts], axis=-1) for i in range(3)))]
            return parts[0]

        def out(lang: str) -> pa.RecordBatch:
            _, words, n = counted(lang)
            held.pop(lang)
            pa.default_memory_pool().release_unused()
            return pa.record_batch({"lang": pa.array([lang] * len(n), pa.string())}
                                   | {f"w{i + 1}": pa.array(words[i].view(np.int64)) for i in range(m)} | {"n": pa.array(n)})

        for batch in batches:
            for lang, t in _runs(batch):
                if len(t) < m:
                    continue
                word = t != 0
                inside = word[:len(t) - m + 1].copy()
                for i in range(1, m):
                    inside &= word[i:len(t) - m + 1 + i]
                at = np.flatnonzero(choose(_seed(lang), t, inside))
                if not len(at):
                    continue
                columns = np.stack([t[at + i] for i in range(m)])
                part = _merged(_hash(list(columns)), columns, np.ones(len(at), np.int64))
                held.setdefault(lang, []).append(part)
                rows += len(part[0])
                if rows > HELD:
                    rows = sum(len(counted(x)[0]) for x in held)
                    if rows > HELD // 2:
                        for x in list(held):
                            yield out(x)
                        rows = 0
        for lang in list(held):
            yield out(lang)
    return run


def _pairs(frequent):
    def choose(seed, t, inside):
        known = _has(frequent.value, seed, t)
        return inside & known[:-1] & known[1:]
    return choose


def _longer(m: int, pairs, grown):
    """Phrases whose first or last m - 1 words are in ``grown`` and whose pairs all occur often enough."""
    def choose(seed, t, inside):
        two = _has(pairs.value, seed, _hash([t[:-1], t[1:]]))
        for i in range(m - 1):
            inside = inside & two[i:len(inside) + i]
        k = m - 1
        part = two if k == 2 and grown is pairs else \
            _has(grown.value, seed, _hash([t[i:len(t) - k + 1 + i] for i in range(k)]))
        return inside & (part[:-1] | part[1:])
    return choose


def _exactly(m: int, wanted):
    def choose(seed, t, inside):
        return inside & _has(wanted.value, seed, _hash([t[i:len(t) - m + 1 + i] for i in range(m)]))
    return choose


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _words(m: int, at: int = 1) -> list[str]:
    return [f"w{i}" for i in range(at, at + m)]


def _with(df: DataFrame, counts: DataFrame, m: int, at: int, name: str) -> DataFrame:
    """``df`` with the count of its words ``at`` .. ``at + m - 1`` as ``name``."""
    other = counts.select("lang", *(F.col(f"w{i + 1}").alias(f"w{at + i}") for i in range(m)), F.col("n").alias(name))
    return df.join(other, ["lang", *_words(m, at)], "left")


def _score(a: str, left: str, right: str):
    whole = lambda c: f"CAST(`{c}` AS DECIMAL(20,0))"
    return F.expr(f"CAST({SCALE} AS DECIMAL(7,0)) * {whole(a)} div ({whole(left)} + {whole(right)})")


def _scored(counts: list, m: int) -> DataFrame:
    """Phrases of m words with a, l, r, score of the worst cut, and the bound of what grows out of them.

    ``counts[j]`` holds (lang, w1 .. wj, n); a phrase whose parts are not all known has no score.
    """
    df = counts[m].withColumnRenamed("n", "a")
    for k in range(1, m):
        df = _with(df, counts[k], k, 1, f"l{k}")
        df = _with(df, counts[m - k], m - k, k + 1, f"r{k}")
    cuts = [F.struct(_score("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"),
                     F.col(f"r{k}").alias("r")) for k in range(1, m)]
    worst = F.least(*cuts) if m > 2 else cuts[0]
    known = F.lit(True)
    best = None
    for k in range(1, m):
        known = known & F.col(f"l{k}").isNotNull() & F.col(f"r{k}").isNotNull()
        # where a part is not counted, the phrase's own count is the least that it can be
        df = df.withColumn(f"x{k}", F.coalesce(f"l{k}", "a")).withColumn(f"y{k}", F.coalesce(f"r{k}", "a"))
        cut = _score("a", f"x{k}", f"y{k}")
        best = cut if best is None else F.least(best, cut)
    return df.withColumn("cut", F.when(known, worst)).withColumn("bound", _score("a", "l1", "a")) \
        .withColumn("at_most", best) \
        .select("lang", *_words(m), "a", "cut.l", "cut.r", "cut.score", "bound", "at_most")


def _levels(pairs: DataFrame, langs: DataFrame, top: int, times: int | None) -> DataFrame:
    """(lang, level): the score of the pair of rank ``top * times``, zero where there are fewer pairs."""
    if times is None:
        return langs.select("lang", F.lit(0).cast("long").alias("level"))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score")))) \
        .where(F.col("rank") <= top * times)
    at = ranked.where(F.col("rank") == top * times).select("lang", F.col("score").alias("level"))
    return langs.join(at, "lang", "left").select("lang", F.coalesce("level", F.lit(0)).cast("long").alias("level"))


def _survivors(scored: DataFrame, longer: DataFrame | None, m: int, share: int) -> DataFrame:
    """Phrases of m words that no phrase of m + 1 words drops."""
    if longer is None:
        return scored
    inside = longer.select("lang", *_words(m), "n").unionByName(
        longer.select("lang", *(F.col(f"w{i + 1}").alias(f"w{i}") for i in range(1, m + 1)), "n")) \
        .groupBy("lang", *_words(m)).agg(F.max("n").alias("held"))
    joined = scored.join(inside, ["lang", *_words(m)], "left")
    hundred = F.lit(100).cast("decimal(3,0)") * F.coalesce("held", F.lit(0)).cast("decimal(20,0)")
    return joined.where(hundred < F.lit(share).cast("decimal(3,0)") * F.col("a").cast("decimal(20,0)")).drop("held")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP,
                 share: int = SHARE, wider: tuple = WIDER) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    ``wider`` holds the levels to try before zero; the result does not depend on it.
    """
    spark = docs.sparkSession
    base = work_dir(spark, "collocations")
    one = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text")) \
        .where("text is not null")
    rows = _stored(one.mapInArrow(_token_rows, _TOKEN_SCHEMA), f"{base}/tokens")
    text_rows = rows.where("toks is not null").select("lang", "toks")
    named = rows.where("toks is null").select("lang", F.col("h").alias("w1"), "n", "word")
    sums = named.groupBy("lang").agg(F.sum("n").alias("n"))
    counts: list = [None, _stored(named.groupBy("lang", "w1").agg(F.sum("n").alias("n")).where(F.col("n") >= least), f"{base}/words")]

    def count(m: int, choose, name: str) -> DataFrame:
        schema = ", ".join(["lang string", *(f"{w} long" for w in _words(m)), "n long"])
        part = text_rows.mapInArrow(_grams(m, choose), schema)
        return _stored(part.groupBy("lang", *_words(m)).agg(F.sum("n").alias("n")).where(F.col("n") >= least), f"{base}/{name}")

    counts.append(count(2, _pairs(_bloom(counts[1], 1)), "pairs"))
    two = _stored(_scored(counts, 2), f"{base}/scored-pairs")
    all_pairs = _bloom(counts[2], 2)
    langs = counts[1].select("lang").distinct()
    found = None
    for turn, times in enumerate([*wider, None]):
        level = _stored(_levels(two, langs, top, times), f"{base}/{turn}/level")

        def reached(scored: DataFrame, by: str) -> DataFrame:
            return scored.join(level, "lang").where(F.col(by) >= F.col("level")).drop("level")

        grown = _bloom(reached(two, "bound"), 2)
        three = [*counts, count(3, _longer(3, all_pairs, grown), f"{turn}/threes")]
        scored3 = _stored(_scored(three, 3), f"{base}/{turn}/scored-threes")
        fours = count(4, _longer(4, all_pairs, _bloom(reached(scored3, "bound"), 3)), f"{turn}/fours")
        # last three words of phrases that may still reach the level, not counted so far
        lacking = reached(_scored([*three, fours], 4).where("score is null and bound is not null"), "at_most") \
            .select("lang", *(F.col(f"w{i + 1}").alias(f"w{i}") for i in range(1, 4))).distinct()
        lacking = _stored(lacking.join(three[3], ["lang", *_words(3)], "left_anti"), f"{base}/{turn}/lacking")
        more = count(3, _exactly(3, _bloom(lacking, 3)), f"{turn}/more")
        known3 = three[3].unionByName(more).groupBy("lang", *_words(3)).agg(F.max("n").alias("n"))
        scored4 = _scored([*counts, known3, fours], 4).where("score is not null")
        alive = [reached(_survivors(s, longer, m, share), "score") for m, s, longer in
                 ((2, two, three[3]), (3, scored3, fours), (4, scored4, None))]
        wide = [x.select("lang", *_words(m), *(F.lit(None).cast("long").alias(w) for w in _words(LONGEST - m, m + 1)),
                         "a", "l", "r", "score") for m, x in zip((2, 3, 4), alive)]
        best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
        kept = wide[0].unionByName(wide[1]).unionByName(wide[2]).withColumn("place", F.rank().over(best)) \
            .where(F.col("place") <= top).drop("place")
        kept = _stored(kept, f"{base}/{turn}/kept")
        full = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("have"))
        state = level.join(full, "lang", "left").withColumn("settled", (F.col("level") == 0) | (F.coalesce("have", F.lit(0)) >= top))
        state = _stored(state.select("lang", "settled"), f"{base}/{turn}/state")
        part = kept.join(state.where("settled"), "lang", "left_semi")
        found = part if found is None else found.unionByName(part)
        langs = state.where("not settled").select("lang")
        if langs.isEmpty():
            break
    return _named(found, named, sums, top)


def _named(found: DataFrame, named: DataFrame, sums: DataFrame, top: int) -> DataFrame:
    """The phrases as text, ranked; ``found`` holds at least all that can be among the first."""
    wanted = None
    for w in _words(LONGEST):
        part = found.select("lang", F.col(w).alias("w1")).where("w1 is not null")
        wanted = part if wanted is None else wanted.unionByName(part)
    names = named.join(wanted.distinct(), ["lang", "w1"], "left_semi").groupBy("lang", "w1").agg(F.min("word").alias("word"))
    for i, w in enumerate(_words(LONGEST)):
        found = found.join(names.select("lang", F.col("w1").alias(w), F.col("word").alias(f"t{i}")), ["lang", w], "left")
    phrase = F.concat_ws(" ", *(f"t{i}" for i in range(LONGEST)))  # skips the words that a shorter phrase lacks
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return found.withColumn("phrase", phrase).withColumn("rank", F.row_number().over(order).cast("long")) \
        .where(F.col("rank") <= top).join(sums, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
