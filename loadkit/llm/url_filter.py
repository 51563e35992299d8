"""Judge URLs by rules and by a list of canonical URLs.

A blocked Bloom filter of the listed canonical URLs sorts out most URLs; possible hits go to an exact
hash join with the list, which removes the false positives. Rules come first and are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.llm.common import ascii_lower

# Query parameters that do not name content.
TRACKING = ("ref", "fbclid", "gclid")
BLOCK_BITS = 512
BITS_PER_URL = 12
# The filter has at most this many blocks (64 bytes each, 4 MB in all), so it may always be broadcast.
# A longer list only raises the share of false positives, which the exact join removes.
MAX_BLOCKS = 1 << 16
MAX_RULES = 1000


def host_of(url: Column) -> Column:
    """Host in lower-case A-Z; empty for null and for text without `://`."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without `www.` or `m.`, path without final slashes, content parameters sorted; no scheme, no fragment. Null without a host."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    named = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_") & ~F.substring_index(p, "=", 1).isin(*TRACKING)))
    joined = F.array_join(named, "&")
    return F.when(host_of(url) != "", F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise("")))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting (verdict, `host/path`) rule: its text and its verdict, null where none fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules; put whole URLs on the list")
    text = verdict = F.lit(None).cast("string")
    # The longest rule is tested first, so it wraps the others; of equal ones the first by text wins.
    for what, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1]), reverse=True):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        text = F.when(fits, rule).otherwise(text)
        verdict = F.when(fits, what).otherwise(verdict)
    return text, verdict


def bloom(listed: DataFrame) -> tuple[DataFrame, int]:
    """Blocks of a Bloom filter over column `canonical`: (block, w0 .. w7), and the number of blocks.

    All bits of a URL lie in one block of eight words, one bit in each. Blocks without a URL are left out.
    """
    wanted = -(-listed.count() * BITS_PER_URL // BLOCK_BITS)
    blocks = 1
    while blocks < min(wanted, MAX_BLOCKS):
        blocks *= 2
    words = [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias(f"w{i}") for i, bit in enumerate(_bits())]
    return listed.groupBy(_block(blocks).alias("block")).agg(*words), blocks


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("canonical"), F.lit(blocks)).cast("int")


def _bits() -> list[Column]:
    second = F.xxhash64("canonical", F.lit(1))
    return [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(8)]


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], url: str = "url", key: str = "page_id", default: str = "allow", hit: str = "block") -> DataFrame:
    """(page_id, host, path, rule, verdict, listed) for every row.

    A rule decides first; without one, a canonical URL on the list gives `hit`, any other `default`.
    Null URLs and those without `://` have empty host and path, fit no rule and are never listed. Repeated
    rows are judged each. An empty list lists nothing. `listed` has one column of canonical URLs under any
    name; nulls and repeats in it do not count. Other columns of `pages` are not read.
    """
    listed = listed.toDF("canonical").filter(F.col("canonical").isNotNull()).distinct()
    host, path = F.col("host"), F.col("path")
    parts = pages.select(F.col(key).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), canonical(F.col(url)).alias("canonical"))
    text, verdict = rule_of(host, path, rules)
    filled, blocks = bloom(listed)
    probed = parts.withColumn("block", _block(blocks)).join(F.broadcast(filled), "block", "left")
    maybe = F.col("canonical").isNotNull()
    for i, bit in enumerate(_bits()):
        maybe = maybe & (F.call_function("shiftrightunsigned", F.col(f"w{i}"), bit).bitwiseAND(F.lit(1)) == 1)
    # Rows without a possible hit get stand-in keys that match nothing and spread.
    possible = F.coalesce(maybe, F.lit(False))
    keyed = probed.select("page_id", "host", "path", possible.alias("possible"), F.when(possible, F.col("canonical")).otherwise(F.xxhash64("page_id", "canonical").cast("string")).alias("name"))
    exact = listed.select(F.lit(True).alias("possible"), F.col("canonical").alias("name"), F.lit(True).alias("listed"))
    found = keyed.join(exact, ["possible", "name"], "left").withColumn("listed", F.coalesce(F.col("listed"), F.lit(False)))
    decided = F.coalesce(verdict, F.when(F.col("listed"), hit).otherwise(default))
    return found.select("page_id", "host", "path", text.alias("rule"), decided.alias("verdict"), "listed")
