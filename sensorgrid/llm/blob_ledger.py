"""Secrets in every version of every file, each distinct content scanned once per rule set.

A blob is a content, addressed by its SHA-256. The ledger holds the (blob, rule
version) pairs that were scanned, and the findings of those that had any. A scan takes
the blobs of the given versions that the ledger does not hold for this rule version,
scans them, appends to the ledger, and joins all findings back to the versions' paths.

Everything is built-in functions. Matches come from ``regexp_extract_all``; their
places from splitting the text by the same pattern: lengths of gaps and matches add up
to offsets. Only blobs with a match are split.

Cases: null content is an empty blob; rows that repeat give repeated results; two
paths with one blob share its findings; texts of any length are scanned whole; ties
of spans are ordered by start, then by the rules' order; an empty table scans nothing;
columns other than the named ones are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorgrid.llm.common import saved
from sensorgrid.session import new_path


@dataclass(frozen=True)
class Rule:
    """A kind of secret: all leftmost matches of ``pattern`` whose group is long enough."""

    kind: str
    pattern: str
    group: int
    least: int
    base: bool = True


# The base rules, in the order in which equal starts are listed.
# Runs of one class are taken whole, so their least length is part of the pattern.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
    # What the scan adds: platform tokens and key files.
    Rule("platform", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})", 0, 16, base=False),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 27, base=False),
)
RULE_VERSION = 1


_FOUND = "array<struct<start:int,ord:int,kind:string,end:int>>"
#: Matches whose places are summed up together.
BLOCK = 256


def steps(rule: Rule, text: str = "content") -> Column:
    """(gap, match, value) of the rule's matches: letters before it, in it and in its value."""
    t = F.col(text)
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(t, pattern, F.lit(0))
    values = F.regexp_extract_all(t, pattern, F.lit(rule.group))
    gaps = F.split(t, rule.pattern, -1)
    found = F.arrays_zip(
        F.transform(F.slice(gaps, 1, F.size(matches)), lambda g: F.length(g)).alias("gap"),
        F.transform(matches, lambda m: F.length(m)).alias("match"),
        F.transform(values, lambda v: F.length(v)).alias("value"),
    )
    none = F.array().cast("array<struct<gap:int,match:int,value:int>>")
    return F.when(t.rlike(rule.pattern), found).otherwise(none)


def spans(rule: Rule, order: int, steps: str) -> Column:
    """Array of (start, kind's order, kind, end) of the rule's matches, in code points.

    Gap i stands before match i, so a match starts after all gaps up to its own and
    all matches before it. Matches are taken in blocks: blocks are summed first, then
    the places inside each follow from where it starts, so the work grows with the
    matches and not with their square. ``steps`` is a column: in an expression it would
    be made anew for every block.
    """
    all_ = F.col(steps)
    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(all_) / BLOCK).cast("int")), lambda b: F.slice(all_, b * BLOCK + 1, F.lit(BLOCK))
    )
    length = lambda block: F.aggregate(block, F.lit(0), lambda n, s: n + s["gap"] + s["match"])
    starts = F.aggregate(
        F.transform(blocks, length),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda state, n: F.struct((state["at"] + n).alias("at"), F.array_append(state["starts"], state["at"]).alias("starts")),
    )["starts"]

    def inside(block: Column, start: Column) -> Column:
        one = lambda state, s: F.struct(
            (state["at"] + s["gap"]).alias("start"), F.lit(order).alias("ord"),
            F.lit(rule.kind).alias("kind"), (state["at"] + s["gap"] + s["match"]).alias("end"),
        )
        return F.aggregate(
            block,
            F.struct(start.alias("at"), F.array().cast(_FOUND).alias("found")),
            lambda state, s: F.struct(
                (state["at"] + s["gap"] + s["match"]).alias("at"),
                F.when(s["value"] >= rule.least, F.array_append(state["found"], one(state, s))).otherwise(state["found"]).alias("found"),
            ),
        )["found"]

    return F.flatten(F.zip_with(blocks, starts, inside))


def listed(found: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def blob_id(content: str = "content") -> Column:
    return F.unhex(F.sha2(F.encode(F.col(content), "UTF-8"), 256))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, found) with all spans of every blob, in order."""
    # Out of a generator, as a projection would be copied into the blocks.
    made = F.struct(*[steps(rule).alias(f"steps{k}") for k, rule in enumerate(rules)])
    stepped = blobs.select("blob", F.inline(F.array(made)))
    every = F.concat(*[spans(rule, k, f"steps{k}") for k, rule in enumerate(rules)])
    return stepped.select("blob", F.array_sort(every).alias("found"))


class Ledger:
    """One row per scanned (blob, rule version) with its findings, in a shared folder.

    A scan appends its rows in one write, so a scan that fails leaves none; blobs
    that two scans took at the same time have equal findings and count once.
    """

    SCHEMA = "blob binary, rule_version int, found array<struct<start:int,ord:int,kind:string,end:int>>"

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark = spark
        self.path = path or new_path(spark, "blob-ledger")

    def rows(self, rule_version: int) -> DataFrame:
        """(blob, found) of what was scanned under a rule version."""
        try:
            every = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            every = self.spark.createDataFrame([], self.SCHEMA)
        return every.where(F.col("rule_version") == rule_version).select("blob", "found")

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, rule_version: int = RULE_VERSION) -> DataFrame:
        """The rows of (path, content) ``versions`` as (path, blob, found).

        Copies are merged before their texts are moved, by the task that reads
        them and then by address, so a hot content is scanned once.
        """
        marked = versions.select("path", F.coalesce(F.col("content").cast("string"), F.lit("")).alias("content"))
        marked = marked.withColumn("blob", blob_id())
        blobs = marked.groupBy("blob").agg(F.first("content").alias("content"))
        unseen = blobs.join(self.rows(rule_version).select("blob"), "blob", "left_anti")
        scan_blobs(unseen, rules).select("blob", F.lit(rule_version).alias("rule_version"), "found").write.mode(
            "append").parquet(self.path)
        found = saved(self.rows(rule_version).dropDuplicates(["blob"]), "blob-findings")
        return marked.select("path", "blob").join(found, "blob", "left")


def secret_spans(docs: DataFrame, ledger: Ledger | None = None) -> DataFrame:
    """Counts and spans of every document; without a ledger a new one is begun."""
    ledger = ledger or Ledger(docs.sparkSession)
    found = ledger.scan(docs.select(F.col("doc_id").alias("path"), F.col("text").alias("content")))
    base_kinds = [r.kind for r in RULES if r.base]
    base = F.filter("found", lambda s: s["kind"].isin(base_kinds))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        F.col("path").alias("doc_id"), *[count(k) for k in base_kinds],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"),
    )
