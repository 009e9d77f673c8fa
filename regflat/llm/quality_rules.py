"""Line-first quality rules, as DataFrame expressions only.

Every line of a text is judged by itself (closing punctuation, navigation,
boilerplate, symbols, capitals); failing lines are removed; a document that
loses too large a part of its words is rejected.  All work is per row: the
plan is scan -> project -> write, without a shuffle, so a hot source or a
group of copies costs nothing extra.

Defined results: a null text counts as an empty one (no words, rejected);
repeated rows are judged each by itself; an empty table gives no rows; other
columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# white space of the word rule: \x20 and \x09 to \x0D
TRIM = " \t\n\x0b\f\r"

WINDOW = 8          # words of a window when counting repetition
MIN_WORDS = 20      # fewer words: rejected
MAX_REPEAT_PCT = 30  # a larger share of repeated words: rejected
MAX_LOST = 0.5      # a larger share of words on removed lines: rejected

# line rules: plain substrings and character sets, which cost far less per line than alternations
CLOSING = (".", "!", "?", "…", ":", ";", '"', "'", "”", "’", "»", ")", "]")
BARS = (" | ", " » ", " › ", " · ")
BOILERPLATE = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie", "javascript", "lorem ipsum",
    "licensed under", "copyright ©", "subscribe to our", "sign in to", "sign up for", "click here", "read more",
    "next page", "previous page",
)
MARKS = "#*$%&|<>{}"
SYMBOLS = "#*$%&|<>"  # counted as n_symbols


def spaced(text: Column, keep: str = "") -> Column:
    """The words joined by one space; white space named in ``keep`` stays as it is."""
    out = text
    for c in TRIM[1:]:
        if c not in keep:
            out = F.replace(out, F.lit(c), F.lit(" "))
    out = F.when(F.contains(out, F.lit("  ")), F.regexp_replace(out, " {2,}", " ")).otherwise(out)
    return F.btrim(out, F.lit(" "))


def count_words(spaced_text: Column) -> Column:
    """Words of a text that ``spaced`` returned: its spaces and one, or none."""
    return F.when(spaced_text == "", F.lit(0)).otherwise(
        F.char_length(spaced_text) - F.char_length(F.replace(spaced_text, F.lit(" "), F.lit(""))) + 1)


def _times(text: Column, part: str) -> Column:
    """How often a substring occurs."""
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit(part), F.lit("")))) / len(part)


def _any(text: Column, parts) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | F.contains(text, F.lit(part))
    return found


def holds(text: Column) -> Column:
    """What the lines of a text can fail by: whether it holds a bar, a stock phrase, a mark, a double exclamation mark, and
    whether words are parted by more than single spaces."""
    return F.struct(_any(text, BARS).alias("bar"), _let(F.lower(text), lambda low: _any(low, BOILERPLATE)).alias("stock"),
                    _any(text, MARKS).alias("mark"), F.contains(text, F.lit("!!")).alias("shout"),
                    _any(text, ("  ", *TRIM.replace(" ", "").replace("\n", ""))).alias("gaps"))


def line_kept(line: Column, screen: Column | None = None) -> Column:
    """True for a line that passes every rule; a line without words passes.

    A line fails as navigation (fewer than four words without a closing mark,
    or three and more items between bars), as boilerplate (a stock phrase, in
    any case), as symbols (over three marks to ten words) or as shouting (a
    double exclamation mark to every second word, or capitals throughout).
    ``screen`` is what the whole text ``holds``: rules that no line can fail
    are left out.
    """
    def may(what: str, rule: Column) -> Column:
        return rule if screen is None else F.when(screen[what], rule).otherwise(F.lit(False))

    def verdict(n):
        bars = sum((_times(line, bar) for bar in BARS), F.lit(0))
        marks = sum((_times(line, mark) for mark in MARKS), F.lit(0))
        closed = F.right(F.btrim(line, F.lit(TRIM)), F.lit(1)).isin(*CLOSING)
        return (n == 0) | ~(
            ((n < 4) & ~closed)
            | may("bar", bars >= 2)
            | may("stock", _let(F.lower(line), lambda low: _any(low, BOILERPLATE)))
            | may("mark", marks * 10 > n * 3)
            | may("shout", _times(line, "!!") * 2 > n)
            # most lines hold a small letter of ASCII, which settles it
            | ((n >= 4) & ~F.rlike(line, F.lit("[a-z]")) & (F.upper(line) == line) & (F.lower(line) != line)))

    words = count_words(spaced(line))
    return _let(words if screen is None else F.when(screen["gaps"], words).otherwise(count_words(F.btrim(line, F.lit(" ")))), verdict)


def clean_lines(text: Column) -> Column:
    """The text without its failing lines."""
    whole = F.coalesce(text, F.lit(""))
    return _let(holds(whole), lambda screen: F.array_join(
        F.filter(F.split(whole, "\n"), lambda line: line_kept(line, screen)), "\n"))


def repeated_words(spaced_text: Column, width: int = WINDOW) -> Column:
    """Words lying in ``width``-word windows that occur twice or more, first occurrences included.

    ``spaced_text`` as from ``spaced``.  Words and windows are told apart by
    64-bit hash; only a text in which two windows agree goes on to place them.
    """
    def windows(h):
        return F.transform(F.slice(h, 1, F.size(h) - width + 1),
                           lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, width))))

    def positions(p):
        m = F.size(p)
        kept = F.filter(p, lambda x, k: (
            ((k > 0) & (F.get(p, k - 1)["h"] == x["h"])) | ((k < m - 1) & (F.get(p, k + 1)["h"] == x["h"]))))
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    def total(at):
        k = F.size(at)
        gaps = F.zip_with(F.slice(at, 1, k - 1), F.slice(at, 2, k - 1), lambda a, b: F.least(b - a, F.lit(width)))
        return F.aggregate(gaps, F.lit(width), lambda s, g: s + g)

    def covered(ws):
        placed = F.sort_array(F.transform(ws, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(ws)) < F.size(ws), _let(_let(placed, positions), total)).otherwise(F.lit(0))

    hashes = F.transform(F.split(spaced_text, " "), lambda w: F.xxhash64(w))
    return _let(hashes, lambda h: F.when(F.size(h) >= width, _let(windows(h), covered)).otherwise(F.lit(0))).cast("long")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_lost: float = MAX_LOST) -> DataFrame:
    """One row per input row: counts, the cleaned text and the verdicts.

    Columns: the id, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``n_words_kept``, ``clean_text``,
    ``base_failed``, ``kept``.  ``kept`` is false when the base rules fail or
    more than ``max_lost`` of the words stood on removed lines.
    """
    text = F.coalesce(F.col("_t"), F.lit(""))
    one = docs.select(F.col(id_col), F.col(text_col).alias("_t"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(TRIM)) != "")
    counted = one.select(
        F.col(id_col),
        _let(spaced(text), lambda w: F.struct(
            count_words(w).cast("long").alias("n_words"),
            F.char_length(F.replace(w, F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"))).alias("_w"),
        sum((_times(text, c) for c in SYMBOLS), F.lit(0)).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        clean_lines(F.col("_t")).alias("clean_text"),
    )
    kept_words = _let(spaced(F.col("clean_text")), count_words).cast("long")
    failed = (F.col("_w.n_words") < MIN_WORDS) | (
        100 * F.col("_w.n_repeat_words") > MAX_REPEAT_PCT * F.col("_w.n_words"))
    return counted.select(
        F.col(id_col), F.col("_w.n_words"), F.col("_w.word_chars"), "n_symbols", "n_dup_lines",
        F.col("_w.n_repeat_words"), kept_words.alias("n_words_kept"), "clean_text", failed.alias("base_failed"),
    ).withColumn("kept", ~F.col("base_failed") & (
        (F.col("n_words") - F.col("n_words_kept")) <= max_lost * F.col("n_words")))
