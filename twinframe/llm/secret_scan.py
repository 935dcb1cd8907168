"""Secret scans over an incremental ledger of content-addressed blobs, in DataFrame functions only.

Every historical version of a file is addressed by the SHA-256 of its text. The ledger holds, for each blob, which versions of which
rules have read it and the spans they found. A scan reads only blobs with unseen (rule, version) pairs, one text for each blob however
many paths hold it, appends its findings to the ledger, and joins the ledger back to all paths.

Positions are code points, end exclusive. They come from the lengths of the pieces between matches: split() and regexp_extract_all()
step through the same leftmost non-overlapping matches. A null text is read as empty; equal texts share one ledger row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinframe.llm.common import HOT_KEYS, ROWS_A_FILE, fresh_path, hot_keys, hot_limit, shuffles_end, spread_join, written


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    probe: str
    """A pattern at least as wide: texts without it are not taken apart."""
    group: int = 0
    least: int = 1
    """Code points that the group must have."""

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules' patterns and least lengths. A maximal run of at least n characters is the same as a run that is then tested for its length.
BASE_RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"""(?i)(?:passw(?:or)?d|secret|token|api_?key)["']?\x20*[:=]""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", r"AKIA[A-Z0-9]{16}"),
    Rule("hex", 1, r"[0-9a-f]{24,}", r"[0-9a-f]{24}"),
)
#: What the method adds to the base spans.
MORE_RULES = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", "PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ"),
    Rule("forge_token", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_"),
)
RULES = BASE_RULES + MORE_RULES
SPANS = "array<struct<start:int,ord:int,end:int,kind:string,rule:string>>"


def _spans(text: Column, rule: Rule, ord_: int) -> Column:
    """The spans of one rule in one text."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x))
    parts = F.arrays_zip(gaps.alias("gap"), F.transform(whole, lambda x: F.length(x)).alias("len"), F.transform(group, lambda x: F.length(x)).alias("own"))
    none = F.array().cast(SPANS)
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + p["gap"]
        end = begin + F.coalesce(p["len"], F.lit(0))  # the last gap has no match after it
        span = F.struct(begin.alias("start"), F.lit(ord_).alias("ord"), end.alias("end"), F.lit(rule.kind).alias("kind"), F.lit(rule.key).alias("rule"))
        found = F.when(p["len"].isNotNull() & (p["own"] >= rule.least), F.concat(acc["found"], F.array(span))).otherwise(acc["found"])
        return F.struct(end.alias("at"), found.cast(SPANS).alias("found"))

    return F.when(text.rlike(rule.probe), F.aggregate(parts, start, step)["found"]).otherwise(none)


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Reads what the ledger at `ledger_path` has not seen of versions (a DataFrame with `text`), appends it there and returns the whole ledger.

    The ledger: blob, rules (keys that this row's scan read it with), spans. A blob has a row for each scan that added something.
    A scan that fails leaves no row (the append is committed at its end), so it is simply run again.
    """
    spark = versions.sparkSession
    keys = [r.key for r in rules]
    # a ledger row is short: a hash, the rules' names, spans
    files = max(2, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-versions.count() // ROWS_A_FILE)))
    blobs = versions.select(blob_of(F.col("text")).alias("blob"), F.coalesce(F.col("text"), F.lit("")).alias("text")).dropDuplicates(["blob"])
    target = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
    known = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    todo = F.array(*map(F.lit, keys))
    if known:
        seen = spark.read.parquet(ledger_path).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        blobs = blobs.join(seen, "blob", "left")
        todo = F.array_except(todo, F.coalesce(F.col("seen"), F.array().cast("array<string>")))
    blobs = blobs.select("blob", "text", todo.alias("rules")).where(F.size("rules") > 0)
    each = [F.when(F.array_contains("rules", r.key), _spans(F.col("text"), r, k)).otherwise(F.array().cast(SPANS)) for k, r in enumerate(rules)]
    found = blobs.select("blob", "rules", F.array_sort(F.concat(*each)).alias("spans"))
    with shuffles_end(spark):
        found.repartition(files).write.mode("append").parquet(ledger_path)
    return spark.read.parquet(ledger_path)


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob and its sorted spans under the rules given, for blobs that have any."""
    keys = [r.key for r in rules]
    own = ledger.select("blob", F.filter("spans", lambda s: s["rule"].isin(keys)).alias("spans")).where(F.size("spans") > 0)
    return own.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _hot_blobs(paths: DataFrame) -> DataFrame:
    """The blobs of many paths, for spread_join."""
    total = paths.count()
    return written(hot_keys(paths.groupBy("blob").agg(F.count("*").alias("copies")), ["blob"], "copies", hot_limit(total)), "hot-blobs", HOT_KEYS)


def report(versions: DataFrame, ledger_path: str | None = None, path_column: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row for each row of versions: path_column, blob, n_<base kind>, base_sha256, spans (kind:start:end by start, comma-joined)."""
    found = findings(scan(versions, ledger_path or fresh_path(versions.sparkSession, "blob-ledger"), rules), rules)
    paths = versions.select(F.col(path_column), blob_of(F.col("text")).alias("blob"))
    joined = spread_join(paths, found, ["blob"], _hot_blobs(paths), [path_column], "left")
    spans = F.coalesce(F.col("spans"), F.array().cast(SPANS))
    base_kinds = [r.kind for r in BASE_RULES]
    base = F.filter(spans, lambda s: s["kind"].isin(base_kinds))
    counts = [F.size(F.filter(F.transform(spans, lambda s: s["kind"]), lambda x: x == F.lit(k))).cast("long").alias(f"n_{k}") for k in base_kinds]  # noqa: B023
    return joined.select(path_column, "blob", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(spans).alias("spans"))


def _merged(spans: Column) -> Column:
    """Overlapping spans made one, under the first one's kind."""
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")

    def step(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        one = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        joins = (F.size(acc) > 0) & F.coalesce(F.try_element_at(acc, F.lit(-1))["end"] > s["start"], F.lit(False))
        return F.when(joins, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(wider))).otherwise(F.concat(acc, F.array(one)))

    return F.aggregate(spans, none, lambda acc, s: step(acc, s).cast("array<struct<start:int,end:int,kind:string>>"))


def redact(docs: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs (same columns, all rows) with every found span replaced by [kind]; texts without a finding stay as they are, null stays null.

    n_chars, if there, is counted anew for changed texts.
    """
    found = findings(scan(docs, ledger_path or fresh_path(docs.sparkSession, "blob-ledger"), rules), rules)
    blob, spans = "__twinframe_blob", "__twinframe_cut"
    cut = found.select(F.col("blob").alias(blob), _merged(F.col("spans")).alias(spans))
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(s["end"].alias("at"), F.concat(acc["out"], kept, F.lit("["), s["kind"], F.lit("]")).alias("out"))

    done = F.aggregate(F.col(spans), start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    columns = {"text": F.when(F.col(spans).isNull() | text.isNull(), text).otherwise(done)}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col(spans).isNull() | text.isNull(), F.col("n_chars")).otherwise(F.length(done).cast(docs.schema["n_chars"].dataType))
    hashed = docs.withColumn(blob, blob_of(text))
    hot = _hot_blobs(hashed.select(F.col(blob).alias("blob"))).withColumnRenamed("blob", blob)
    joined = spread_join(hashed, cut, [blob], hot, ["doc_id"] if "doc_id" in docs.columns else docs.columns, "left")
    return joined.select(*(columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns))
