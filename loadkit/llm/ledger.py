"""Secret scans with a ledger of blobs. DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its text, its blob. The ledger records which (blob, rule
version) pairs have been scanned and what was found. A scan looks up the pairs it lacks, reads one text for each
blob that has any, applies the rules that are new to that blob, records the outcome, and joins the findings of all
blobs back to their paths. A version of a rule is a digest of what it says, so an edited rule is scanned anew and the others are not.

The ledger is a folder of runs; a run counts once Spark has marked it complete, so a scan that was broken off is
repeated. Pairs recorded twice do no harm.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadkit.llm.common import unused
from loadkit.session import BROADCAST_ROWS, stage


@dataclass(frozen=True)
class Rule:
    """Leftmost matches that do not overlap; one counts if `group` (0: all of it) has `least` characters or more.

    A pattern must match no empty text and mean the same to Java and RE2, and it must not repeat a group without bound, which Java does by recursion.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        return f"{self.kind}@{hashlib.sha256(repr((self.pattern, self.group, self.least)).encode()).hexdigest()[:16]}"


def either_case(words: str) -> str:
    """A pattern with each a-z in either case. Case flags are not used: engines differ in the letters beyond A-Z they fold."""
    return "".join(f"[{c}{c.upper()}]" if "a" <= c <= "z" else c for c in words)


# The base scan. A run of 24 or 20 characters is found as such, for a shorter one never holds a longer one.
BASE = (
    Rule("assign", f"({either_case('password|passwd|secret|token|api_?key')})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
# Public formats of keys and tokens.
MORE = (
    Rule("github", "gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", "-----BEGIN [A-Z0-9\\x20]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\\x20\\x09-\\x0D]*"),
    Rule("login", "://[^\\x00-\\x20/:@]{1,64}:[^\\x00-\\x20/:@]{1,64}@"),
)
RULES = BASE + MORE

_RECORD = "blob binary, rules array<string>, found array<struct<rule:string,start:bigint,end:bigint>>"


def address(text: Column) -> Column:
    """The blob of a text: its SHA-256 as 32 bytes. Null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _complete_runs(spark: SparkSession, root: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    runs = sorted(f"{root}/{s.getPath().getName()}" for s in fs.listStatus(where))
    return [r for r in runs if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{r}/_SUCCESS"))]


def recorded(spark: SparkSession, root: str) -> DataFrame:
    """(blob, rules, found) of all complete runs: rule versions scanned, and their spans. A blob has a row for each run that scanned it."""
    runs = _complete_runs(spark, root)
    return spark.read.schema(_RECORD).parquet(*runs) if runs else spark.createDataFrame([], _RECORD)


def _matches(text: Column, no: int, rule: Rule) -> Column:
    """(rule, at, gap, size, good) of each match: characters since the last match or the start, and its own.

    The row after the last match has no size. Texts between matches and matches are zipped first, so each is worked out once.
    """
    given = [F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))]
    given += [F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))] if rule.group else []

    def one(x: Column, at: Column) -> Column:
        good = F.length(x[str(len(given) - 1)]) >= rule.least
        return F.struct(F.lit(no).alias("rule"), at.alias("at"), F.length(x["0"]).cast("bigint").alias("gap"), F.length(x["1"]).cast("bigint").alias("size"), good.alias("good"))

    return F.transform(F.arrays_zip(*given), one)


def _unseen(blobs: DataFrame, root: str, rules: tuple[Rule, ...]) -> DataFrame | None:
    """(blob, wanted) of blobs with rule versions the ledger lacks, a bit for each rule; None if the ledger is empty."""
    spark = blobs.sparkSession
    versions = [r.version for r in rules]
    if not _complete_runs(spark, root):
        return None
    # A bit for each rule: the state of a blob is one number however often it was scanned.
    bits = F.aggregate("rules", F.lit(0).cast("bigint"), lambda held, v: held.bitwiseOR(_bit_of(v, versions)))
    done = recorded(spark, root).groupBy("blob").agg(F.bit_or(bits).alias("done"))
    every = (1 << len(rules)) - 1
    wanted = F.lit(every).cast("bigint").bitwiseAND(F.bitwise_not(F.coalesce("done", F.lit(0).cast("bigint"))))
    return blobs.join(done, "blob", "left").select("blob", wanted.alias("wanted")).filter("wanted <> 0")


def _bit_of(version: Column, versions: list[str]) -> Column:
    bit = F.lit(0).cast("bigint")
    for no, known in enumerate(versions):
        bit = F.when(version == known, F.lit(1 << no).cast("bigint")).otherwise(bit)
    return bit


def _texts(versions: DataFrame, blobs: DataFrame, root: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, text, wanted): one text for each blob with something to scan. Copies are merged within tasks before the shuffle."""
    taken = versions.select(address(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    unseen = _unseen(blobs, root, rules)
    once = lambda rows, *more: rows.groupBy("blob").agg(F.first("text").alias("text"), *[F.first(m).alias(m) for m in more])
    if unseen is None:
        return once(taken).withColumn("wanted", F.lit((1 << len(rules)) - 1).cast("bigint"))
    unseen = stage(unseen, "ledger-unseen")
    if unseen.count() <= BROADCAST_ROWS:  # 40 bytes a row; texts that are known are not shuffled
        return once(taken.join(F.broadcast(unseen), "blob"), "wanted")
    return once(taken).join(unseen, "blob")


def _found(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of texts. Positions are running sums over the matches of a text, so a text with very many stays linear."""
    nothing = F.array().cast("array<struct<rule:int,at:int,gap:bigint,size:bigint,good:boolean>>")
    due = [F.col("wanted").bitwiseAND(F.lit(1 << no).cast("bigint")) != 0 for no in range(len(rules))]
    hits = [F.when(due[no] & F.col("text").rlike(r.pattern), _matches(F.col("text"), no, r)).otherwise(nothing) for no, r in enumerate(rules)]
    rows = texts.select("blob", "wanted", F.explode_outer(F.flatten(F.array(*hits))).alias("m")).select("blob", "wanted", "m.*")
    upto = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    versions = F.array(*[F.lit(r.version) for r in rules])
    end = F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(upto)
    spans = rows.withColumn("end", end).withColumn("span", F.when(F.col("good"), F.struct(F.get(versions, F.col("rule")).alias("rule"), (F.col("end") - F.col("size")).alias("start"), "end")))
    scanned = F.array_compact(F.array(*[F.when(due[no], r.version) for no, r in enumerate(rules)]))
    return spans.groupBy("blob").agg(F.first("wanted").alias("wanted"), F.collect_list("span").alias("found")).select("blob", scanned.alias("rules"), "found")


def scan(versions: DataFrame, root: str, rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns in `keep` (path, version) and `found` (rule, kind, start, end) of every row, by start, then in the order of `rules`.
    The name is lengthened if `keep` has it.

    `root` is the ledger's folder, which every executor reaches; it gets one more run if a pair was unseen. Starts and
    ends are code points, ends exclusive. Null texts count as empty and find nothing. Repeated rows and equal texts
    give equal findings and are scanned once; null paths stay; no rows give no rows and record nothing; other columns are not read.
    """
    if not 0 < len(rules) < 63:
        raise ValueError("1 to 62 rules")
    spark = versions.sparkSession
    blob, found = unused(list(keep), "_blob"), unused(list(keep), "_found")
    paths = stage(versions.select(*keep, address(F.col(text)).alias(blob)), "ledger-paths")
    blobs = paths.select(F.col(blob).alias("blob")).distinct()
    fresh = _found(_texts(versions.select(F.col(text).alias("text")), blobs, root, rules), rules)
    if paths.limit(1).count():
        fresh.write.mode("errorifexists").parquet(f"{root}/run-{uuid.uuid4().hex}")

    order = F.create_map(*[F.lit(x) for no, r in enumerate(rules) for x in (r.version, no)])
    kinds = F.create_map(*[F.lit(x) for r in rules for x in (r.version, r.kind)])
    known = F.filter("found", lambda s: F.map_contains_key(order, s["rule"]))
    known = F.transform(known, lambda s: F.struct(s["start"].alias("start"), order[s["rule"]].alias("no"), s["end"].alias("end"), s["rule"].alias("rule")))
    held = recorded(spark, root).select(F.col("blob").alias(blob), known.alias("found")).filter(F.size("found") > 0)
    held = held.groupBy(blob).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("spans"))
    spans = F.transform("spans", lambda s: F.struct(s["rule"].alias("rule"), kinds[s["rule"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    empty = F.array().cast("array<struct<rule:string,kind:string,start:bigint,end:bigint>>")
    held = held.select(blob, spans.alias(found))
    return paths.join(held, blob, "left").select(*keep, F.coalesce(F.col(found), empty).alias(unused(list(keep), "found")))
