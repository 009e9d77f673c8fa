"""URL filter: host/path rules, then a blocked Bloom filter before an exact join.

A list of canonical URLs becomes a blocked Bloom filter held as a table: one
row per non-empty 64-bit block, each key setting ``K`` bits of one block.
Pages probe their block (one 64-bit word each); only possible hits go on to
the exact hash join with the list, which removes false positives.  The filter
has ``BITS_PER_KEY`` bits per listed URL; it is broadcast only when its block
count proves it small, otherwise the probe is a shuffled join on the block.

Defined results: a null URL, or one without ``://``, has an empty host and
path, fits no rule and is on no list; repeated rows are judged each; an empty
table or list gives no rows / no hits; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
BITS_PER_KEY = 16
K = 5                       # bits set per key
MAX_BROADCAST_BLOCKS = 1 << 18  # 16 bytes a block: 4 MB at most

# (verdict, host, path); a rule covers its host and all subdomains
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a leading ``www.`` or ``m.`` plus path without ``.html`` and closing slashes; null if no host.

    Scheme, query and fragment do not count.
    """
    h = F.regexp_replace(host(url), r"^(www|m)\.", "")
    p = F.regexp_replace(F.regexp_replace(path(url), r"\.html$", ""), r"/+$", "")
    return F.when(h != "", F.concat(h, p))


def rule_of(host_: Column, path_: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (verdict, rule); null if none fits."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((host_ == h) | F.endswith(host_, F.lit("." + h))) & F.startswith(path_, F.lit(p))
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(out)
    return out


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column) -> Column:
    h = F.xxhash64(key, F.lit(1))
    out = None
    for i in range(K):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"),
                              F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def bloom_blocks(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter as a table (``_block``, ``_word``)."""
    return listed.groupBy(_block(F.col(key), blocks).alias("_block")).agg(F.bit_or(_mask(F.col(key))).alias("_word"))


def probe(pages: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``pages`` with ``_possible``: does the filter of the distinct keys ``_k`` pass ``key``?  A null passes never."""
    blocks = max(1, -(-keys.count() * BITS_PER_KEY // 64))
    table = bloom_blocks(keys, "_k", blocks)
    if blocks <= MAX_BROADCAST_BLOCKS:
        table = F.broadcast(table)
    passes = F.col("_word").bitwiseAND(_mask(F.col(key))) == _mask(F.col(key))
    return pages.withColumn("_block", F.when(F.col(key).isNotNull(), _block(F.col(key), blocks))) \
        .join(table, "_block", "left") \
        .withColumn("_possible", F.col(key).isNotNull() & F.coalesce(passes, F.lit(False))).drop("_block", "_word")


def on_list(pages: DataFrame, listed: DataFrame, key: str, listed_key: str) -> DataFrame:
    """``pages`` with ``_listed``: is ``key`` among the distinct values of ``listed_key``?

    Probing is a join with one row per block.  Only the rows that the filter
    passes are joined with the list itself; those that it stops go into no
    exchange of that join.
    """
    keys = listed.select(F.col(listed_key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    probed = probe(pages, keys, key)
    hits = probed.where("_possible").drop("_possible")
    exact = hits.join(keys.withColumn("_hit", F.lit(True)), hits[key] == keys["_k"], "left") \
        .withColumn("_listed", F.coalesce("_hit", F.lit(False))).drop("_k", "_hit")
    return exact.unionByName(probed.where("not _possible").withColumn("_listed", F.lit(False)).drop("_possible"))


def filter_urls(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
                listed_col: str = "url", rules=RULES) -> DataFrame:
    """``id, host, path, rule, verdict, listed`` per page row.

    The longest fitting rule decides; without one, a page whose canonical URL
    is on the list is blocked and any other is allowed.
    """
    u = F.col("_u")
    one = pages.select(F.col(id_col), F.col(url_col).alias("_u")).select(
        F.col(id_col), host(u).alias("host"), path(u).alias("path"), canonical(u).alias("_key"))
    marked = on_list(one.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)),
                     listed.select(canonical(F.col(listed_col)).alias("_listed_key")), "_key", "_listed_key")
    return marked.select(
        F.col(id_col), "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("_listed"), "block").otherwise("allow")).alias("verdict"),
        F.col("_listed").alias("listed"))
