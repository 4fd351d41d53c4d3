"""Secret scans with an incremental ledger of blobs, in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content. Pairs of blob and rule version that the ledger
holds are not scanned again; each unseen blob is scanned once, however many paths have it, and entered in the ledger,
also when it has no findings. Findings are joined back to all paths from the ledger, which is a stored table, so Spark splits
the join where many paths have one blob. Spans come from cutting a blob by a rule: the lengths of the pieces and matches,
summed in order, give code-point offsets; the sums run over rows, so a blob of many findings costs in
proportion.

Null and empty contents are one (empty) blob without findings. Repeated rows are returned each, and a null path
as such. Of repeated ledger entries one counts. Extra columns of the versions, also of clashing names, are ignored. A
table without rows gives one, and leaves the ledger as it was."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm import common as C


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of the pattern (leftmost, not overlapping) whose group has `least` characters."""

    kind: str
    pattern: str
    group: int
    least: int


# Patterns, groups and lengths, in the order that ranks kinds.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),  # the runs of [0-9a-f]+ that are long enough; shorter ones need no row
)
# Published forms of keys and tokens, besides the base kinds.
MORE_RULES = (
    Rule("key_block", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    Rule("code_host", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,})", 0, 1),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
)
RULE_VERSION = "2"
FINDINGS = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"
LEDGER = f"blob string, rule_version string, findings {FINDINGS}"


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob and its findings, by start and then by rule, of each blob (blob, text); none for a clean one."""
    cuts = []
    for k, r in enumerate(rules):
        p = F.lit(r.pattern)
        cut = F.when(F.col("text").rlike(r.pattern), F.arrays_zip(F.split("text", r.pattern, -1).alias("piece"), F.regexp_extract_all("text", p, 0).alias("whole"), F.regexp_extract_all("text", p, r.group).alias("part")))
        cuts.append(F.struct(F.lit(k).alias("rank"), cut.alias("cut")))
    clean = F.array(F.struct(F.lit("").alias("piece"), F.lit(None).cast("string").alias("whole"), F.lit(None).cast("string").alias("part")))
    cuts.append(F.struct(F.lit(len(rules)).alias("rank"), clean.alias("cut")))  # a row that a clean blob has too
    rows = blobs.select("blob", F.explode(F.array(*cuts)).alias("c")).select("blob", "c.rank", F.posexplode("c.cut").alias("i", "m"))
    rows = rows.select("blob", "rank", "i", F.length("m.piece").cast("long").alias("before"), F.length("m.whole").cast("long").alias("n"), F.length("m.part").alias("part"))
    w = Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("before") + F.coalesce("n", F.lit(0))).over(w))
    least = F.try_element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("rank") + 1)
    kind = F.try_element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("rank") + 1)
    hit = F.when(F.col("n").isNotNull() & (F.col("part") >= least), F.struct((F.col("end") - F.col("n")).alias("start"), "rank", kind.alias("kind"), "end"))
    return rows.groupBy("blob").agg(F.sort_array(F.collect_list(hit)).alias("findings"))


def scan(versions: DataFrame, ledger: DataFrame | None = None, path: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION, ledger_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(path, blob and findings of every version; the whole ledger).

    Known are the entries of `ledger` and those written under ledger_path already. Entries of blobs scanned now are appended under
    ledger_path, a folder that driver and executors share (a new one in the shared folder where none is named)."""
    spark = versions.sparkSession
    where = ledger_path or C.new_path(spark, "ledger")
    content = F.coalesce(F.col(text), F.lit(""))
    named = versions.select(F.col(path).alias("_path"), F.sha2(content, 256).alias("blob"), content.alias("text"))
    fields = ("blob", "rule_version", "findings")
    older = [ledger.select(*fields)] if ledger is not None else []
    if _written(spark, where):
        older.append(spark.read.schema(LEDGER).parquet(where))
    unseen = named.groupBy("blob").agg(F.first("text").alias("text"))
    for known in older:
        unseen = unseen.join(known.filter(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")
    scan_blobs(unseen, rules).select("blob", F.lit(rule_version).alias("rule_version"), "findings").write.mode("append").parquet(where)
    whole = spark.read.schema(LEDGER).parquet(where)
    if ledger is not None:
        whole = whole.unionByName(ledger.select(*fields).join(whole.select("blob", "rule_version"), ["blob", "rule_version"], "left_anti").select(*fields))
    hits = whole.filter((F.col("rule_version") == rule_version) & (F.size("findings") > 0)).select("blob", "findings")
    if older:
        hits = C.table(hits.dropDuplicates(["blob"]), "hits")
    return named.select("_path", "blob").join(hits, "blob", "left").select(F.col("_path").alias(path), "blob", "findings"), whole


def _written(spark, where: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(where)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    """Through a new ledger in the shared folder, which holds every blob of the table afterwards."""
    every = RULES + MORE_RULES
    out, _ = scan(C.load(spark, sf_dir, "documents"), rules=every)
    found = F.coalesce("findings", F.array().cast(FINDINGS))
    base = F.filter(found, lambda x: x["rank"] < len(RULES))
    line = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")
    return out.select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in RULES], F.sha2(line(base), 256).alias("base_sha256"), line(found).alias("spans"))
