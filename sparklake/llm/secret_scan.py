"""Secret scans with an incremental blob ledger.

Every version of every path is content-addressed by the SHA-256 of its text (a blob).  The ledger has a row for
each blob and scan: the rule versions that were applied and what they found.  A scan takes from the
input only blobs with a rule version that the ledger lacks, one copy of each, adds what it finds to
the ledger, and joins all findings back to all paths of each blob.

Everything is DataFrame functions.  A match's place is the length of what ``split`` leaves before it and of the
matches before it, summed by a window over the blob's matches of that rule.

Defined results: null text counts as empty; empty texts have no findings; null paths are paths;
repeated rows get the same findings; an empty table gives an empty result and leaves the ledger as it is;
extra columns are carried under their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparklake.llm.common import BROADCAST_ROWS, ROW, field, packed, save, small
from sparklake.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` that do not overlap; those with a shorter ``group`` are dropped."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base rules, in the order of their kinds.  A shorter run of hex digits never
#: holds a longer one, so its least length stands in the pattern.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),
)
FOUND = "array<struct<start:long,order:int,rule:string,end:long>>"
LEDGER = f"blob string, rules array<string>, found {FOUND}"


def _path(docs: DataFrame) -> Column:
    return F.coalesce(field(docs, "doc_id").cast("string"), F.lit(""))


def _blob(docs: DataFrame) -> Column:
    return F.sha2(F.coalesce(field(docs, "text"), F.lit("")), 256)


def _pair(a: str, b: str) -> list[Column]:
    return [F.xxhash64(a, b).alias("key_a"), F.xxhash64(b, a).alias("key_b")]


def unseen(paths: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, path, todo): blobs that lack a rule version, one of their paths, and the rules to apply."""
    blobs = paths.groupBy("blob").agg(F.min("path").alias("path"))
    every = F.array(*[F.lit(r.name) for r in rules])
    if ledger is None:
        return blobs.withColumn("todo", every)
    seen = ledger.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    todo = F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "path", todo.alias("todo")).where(F.size("todo") > 0)


def matches(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, start, order, rule, end) of every match in ``texts`` (blob, text, todo), in code points.

    ``todo`` has a bit for each rule to apply.
    """
    def lengths(of: Column) -> Column:
        return F.transform(of, lambda x: F.length(x).cast("long"))

    per_rule = []
    for order, rule in enumerate(rules):
        pattern = F.lit(rule.pattern)
        found = F.struct(F.lit(order).alias("order"),
                         lengths(F.split("text", rule.pattern)).alias("gap"),
                         lengths(F.regexp_extract_all("text", pattern, F.lit(0))).alias("length"),
                         lengths(F.regexp_extract_all("text", pattern, F.lit(rule.group))).alias("part"))
        per_rule.append(F.when((F.getbit("todo", F.lit(order)) == 1) & F.col("text").rlike(rule.pattern), found))
    hits = texts.select("blob", F.explode(F.filter(F.array(*per_rule), lambda x: x.isNotNull())).alias("hit"))
    # a blob's text may come in several rows: one of them counts, or the sums below would add up all
    hits = hits.select("blob", F.col("hit.order").alias("order"), "hit").dropDuplicates(["blob", "order"])
    rows = hits.select("blob", "order", F.posexplode(F.arrays_zip("hit.gap", "hit.length", "hit.part")))
    rows = rows.where("col.length IS NOT NULL").select("blob", "order", "pos", "col.*")  # the text after the last match
    upto = Window.partitionBy("blob", "order").orderBy("pos")
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(upto))
    name = F.element_at(F.array(*[F.lit(r.name) for r in rules]), F.col("order") + 1)
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("order") + 1)
    return placed.where(F.col("part") >= least).select("blob", (F.col("end") - F.col("length")).alias("start"), "order",
                                                       name.alias("rule"), "end")


def scan(docs: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, first: bool = False,
         carry_text: bool = True) -> DataFrame:
    """``docs`` as a struct column ``__row`` with blob and found, after adding to the ledger.

    ``found`` is an array of (start, order, rule, end) by start, then order.  ``first``: the
    ledger does not exist yet.
    """
    spark: SparkSession = docs.sparkSession
    paths = save(docs.select(packed(docs, () if carry_text else ("text",)), _path(docs).alias("path"), _blob(docs).alias("blob")),
                 "secret_paths")
    ledger = None if first else spark.read.schema(LEDGER).parquet(ledger_path)
    todo = save(unseen(paths, ledger, rules), "secret_todo")
    # by two hashes and a bit a rule: three numbers a blob
    bits = sum((F.when(F.array_contains("todo", r.name), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(rules)), F.lit(0))
    wanted = todo.select(*_pair("path", "blob"), bits.alias("todo"))
    texts = docs.select(_path(docs).alias("path"), _blob(docs).alias("blob"), F.coalesce(field(docs, "text"), F.lit("")).alias("text"))
    texts = texts.select("blob", "text", *_pair("path", "blob")).join(small(wanted), ["key_a", "key_b"])
    found = matches(texts.select("blob", "text", "todo"), rules)
    found = found.groupBy("blob").agg(F.sort_array(F.collect_set(F.struct("start", "order", "rule", "end"))).alias("found"))
    entries = todo.select("blob", F.col("todo").alias("rules")).join(found, "blob", "left")
    entries = entries.withColumn("found", F.coalesce("found", F.array().cast(FOUND)))
    entries.select("blob", "rules", "found").write.mode("append").parquet(ledger_path)
    known = spark.read.schema(LEDGER).parquet(ledger_path).select("blob", F.explode("found").alias("f"))
    applied = F.col("f.rule").isin([r.name for r in rules])
    per_blob = (known.where(applied).groupBy(F.col("blob").alias("__blob"))
                .agg(F.sort_array(F.collect_set("f")).alias("found")))
    per_blob = save(per_blob, "secret_found")
    # a blob may have any number of findings: they are counted, not the blobs
    findings = per_blob.agg(F.sum(F.size("found"))).first()[0] or 0
    known_small = small(per_blob) if findings <= BROADCAST_ROWS else per_blob
    return paths.join(known_small, F.col("blob") == F.col("__blob"), "left").select(
        ROW, "blob", F.coalesce("found", F.array().cast(FOUND)).alias("found"))


def digest(docs: DataFrame) -> DataFrame:
    """All documents by two scans: an earlier one, of the blobs whose hash begins with 0 to 7 and without the last rule,
    and one of the whole table with all rules, which takes from the ledger what the earlier one has found."""
    ledger, docs = scratch_path(docs.sparkSession, "secret_ledger"), docs.select("doc_id", "text")
    scan(docs.where(_blob(docs) < "8"), ledger, RULES[:-1], first=True, carry_text=False)
    found = scan(docs, ledger, carry_text=False)

    def kind(f: Column) -> Column:
        return F.substring_index(f["rule"], "@", 1)

    spans = F.array_join(F.transform("found", lambda f: F.concat_ws(
        ":", kind(f), f["start"].cast("string"), f["end"].cast("string"))), ",")
    def count(of: str) -> Column:
        return F.size(F.filter("found", lambda f: kind(f) == of)).cast("long").alias(f"n_{of}")

    counts = [count(r.kind) for r in RULES]
    return found.select(F.col(ROW)["doc_id"].alias("doc_id"), *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


_ORACLE_KIND = """
SELECT doc_id, {order} AS ord, '{kind}' AS kind, unnest(list_transform(string_split_regex(text, r), lambda x: length(x))[:len(m)]) AS gap,
       unnest(list_transform(m, lambda x: length(x))) AS len, unnest(list_transform(p, lambda x: length(x))) AS part,
       unnest(range(len(m))) AS pos, {least} AS least
FROM (SELECT doc_id, text, r, regexp_extract_all(text, r, 0) AS m, regexp_extract_all(text, r, {group}) AS p
      FROM (SELECT doc_id, coalesce(text, '') AS text, '{pattern}' AS r FROM documents))
"""
ORACLE = ("WITH hits AS (" + " UNION ALL ".join(
    _ORACLE_KIND.format(order=i, kind=r.kind, least=r.least, group=r.group, pattern=r.pattern.replace("'", "''"))
    for i, r in enumerate(RULES)) + """), placed AS (
  SELECT *, sum(gap + len) OVER (PARTITION BY doc_id, kind ORDER BY pos)::BIGINT AS e FROM hits),
spans AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || (e - len) || ':' || e, ',' ORDER BY e - len, ord) AS spans
  FROM placed WHERE part >= least GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN spans USING (doc_id)
""")
