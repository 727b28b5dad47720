"""Secret scans by an incremental blob ledger (DataFrame functions only).

A history is a table of versions: every version of every path is a row with its text.
Texts are content-addressed: the SHA-256 of the bytes names a *blob*, so a text
that stands in many paths, branches or versions is one blob.  The *ledger* is a table of the
(blob, rule, rule version) triples already scanned, with what was found; a triple without
a finding has its row too.  A run

1. names the blob of every version,
2. asks the ledger which current rule versions each blob lacks, and scans blobs for just those,
3. adds them to the ledger, and
4. joins the ledger's findings back to all versions that hold the blob.

Unchanged texts are never scanned again, a new rule version rescans for that rule alone, and copies
cost one scan.  A run's rows are written as one folder of the ledger, which appears
whole or not at all; runs that overlap may scan a triple twice, with the same findings.

Matching uses Spark's regular expressions only.  Positions come from the lengths
of the matches and of the texts between them, summed in order over the exploded matches of the
(few) blobs that have any; so a text with many matches costs as much as its length.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from eligo.llm.common import materialize, pick, scratch_path


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose group ``group`` has ``least`` characters or more.

    A new ``version`` makes every blob unseen for this rule.  Patterns match no line end and never
    the empty text.
    """
    kind: str
    version: int
    pattern: str
    least: int = 1
    group: int = 0


def _either_case(words: str) -> str:
    """A pattern's ASCII letters in either case (no Unicode folding: the Kelvin sign is no k)."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


#: The three kinds of the contract, in its order.  The last two are greedy runs whose head is made of
#: the run's own characters, so the long ones among the matches of ``[0-9a-f]+`` are the matches of ``[0-9a-f]{32,}``.
BASE_RULES = (
    Rule("assign", 1, f"({_either_case('password|passwd|secret|token|api_?key')})"
                      r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", 1, "AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, "[0-9a-f]{32,}"),
)
#: Kinds that have forms of their own: key files, tokens of code hosts and chats, signed web tokens.
FORM_RULES = (
    Rule("pem", 1, "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("host_token", 1, "gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", 1, "xox[abprs]-[A-Za-z0-9-]{19,}"),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + FORM_RULES

SPANS = "array<struct<start:bigint,end:bigint>>"
LEDGER = T.StructType([
    T.StructField("blob", T.BinaryType()), T.StructField("kind", T.StringType()),
    T.StructField("version", T.IntegerType()), T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
])


def blob_of(text: Column) -> Column:
    """The content address of a text; null is the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def read_ledger(spark, path: str) -> DataFrame:
    """The triples of all runs; empty where there is no ledger yet."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{path.rstrip('/')}/run=*")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LEDGER)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(blob, kind, version, spans)`` for every kind in ``todo`` of each row of (blob, text, todo).

    Spans are (start, end), in code points, end exclusive, in order; a triple without a finding has none.
    """
    text = F.col("text")

    def cut(r: Rule) -> Column:
        """The match lengths, whether each counts, and the lengths of what stands before each."""
        whole = F.regexp_extract_all(text, F.lit(r.pattern), F.lit(0))
        held = whole if r.group == 0 else F.regexp_extract_all(text, F.lit(r.pattern), F.lit(r.group))
        return F.when(text.rlike(r.pattern), F.arrays_zip(
            F.transform(F.split(text, r.pattern, -1), F.length).alias("before"),
            F.transform(whole, F.length).alias("n"),
            F.transform(held, lambda x: F.length(x) >= r.least).alias("counts")))

    asked = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
                               F.when(F.array_contains("todo", r.kind), cut(r)).alias("m")) for r in rules])
    # Written once: the matches' lengths are small, and the two branches below would each cut them out again.
    found = materialize(blobs.select("blob", "todo", F.explode(asked).alias("r"))
                        .where(F.array_contains("todo", F.col("r.kind")))
                        .select("blob", "r.kind", "r.version", "r.m"), "secret-matches")
    none = found.where("m is null").select("blob", "kind", "version", F.array().cast(SPANS).alias("spans"))
    order = Window.partitionBy("blob", "kind", "version").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    each = (found.where("m is not null").select("blob", "kind", "version", F.posexplode("m").alias("i", "m"))
            .withColumn("end", F.sum(F.col("m.before") + F.coalesce("m.n", F.lit(0))).over(order).cast("bigint")))
    spans = each.groupBy("blob", "kind", "version").agg(F.array_sort(F.collect_list(
        F.when(F.col("m.counts"), F.struct((F.col("end") - F.col("m.n")).alias("start"), F.col("end"))))
    ).cast(SPANS).alias("spans"))
    return none.unionByName(spans)


def unseen_blobs(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(blob, text, todo)``: each blob of (blob, text) that lacks a rule version, once, with the kinds it lacks."""
    current = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    # One row for each blob: at most one entry for each kind and version ever run.
    seen = ledger.groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("seen"))
    blobs = versions.groupBy("blob").agg(F.first("text").alias("text"))   # copies are dropped before the shuffle
    lacks = F.array_except(current, F.coalesce("seen", F.array().cast("array<struct<kind:string,version:int>>")))
    return (blobs.join(seen, "blob", "left").withColumn("todo", F.transform(lacks, lambda x: x["kind"]))
            .where(F.size("todo") > 0).select("blob", "text", "todo"))


def scan_history(versions: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES,
                 id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """One row for each row of ``versions``: ``id_cols``, ``blob`` (hex), ``findings``.

    ``findings`` is an array of (start, end, kind), by start and then by the order of ``rules``; null and
    empty texts have none.  Null and repeated ids are kept as they come.  ``ledger_path`` is a shared folder
    that outlives the run; without one the run has a ledger of its own.
    """
    spark = versions.sparkSession
    ledger_path = ledger_path or scratch_path(spark, "secret-ledger")
    names = [f"id{i}" for i in range(len(id_cols))]
    src = pick(versions, **dict(zip(names, id_cols, strict=True)), text=text_col).withColumn(
        "text", F.coalesce("text", F.lit("")))
    named = src.withColumn("blob", blob_of(F.col("text")))

    new = scan(unseen_blobs(named.select("blob", "text"), read_ledger(spark, ledger_path), rules), rules)
    new.select(*LEDGER.fieldNames()).write.mode("overwrite").parquet(f"{ledger_path.rstrip('/')}/run={uuid.uuid4().hex}")

    # The findings of the current rules, one row for each blob that has any; written before the join,
    # so that a blob with a third of all versions is one row on this side and is split on the other.
    number = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (f"{r.kind}:{r.version}", i)])
    hits = (read_ledger(spark, ledger_path).where(F.size("spans") > 0).withColumn("at", F.try_element_at(
                number, F.concat_ws(":", "kind", "version"))).where("at is not null")
            .select("blob", "at", F.explode("spans").alias("s")).distinct()
            .groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("s.start", "at", "s.end"))).alias("hits")))
    hits = materialize(hits, "secret-findings")
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    findings = F.transform(F.coalesce("hits", F.array().cast("array<struct<start:bigint,at:int,end:bigint>>")), lambda h: F.struct(
        h["start"].alias("start"), h["end"].alias("end"), F.get(kinds, h["at"]).alias("kind")))
    return named.drop("text").join(hits, "blob", "left").select(
        *[F.col(n).alias(c) for n, c in zip(names, id_cols, strict=True)], F.lower(F.hex("blob")).alias("blob"),
        findings.alias("findings"))


def span_text(findings: Column) -> Column:
    """``kind:start:end`` of findings, comma-joined."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def of_kinds(findings: Column, kinds) -> Column:
    return F.filter(findings, lambda f: f["kind"].isin(*kinds))
