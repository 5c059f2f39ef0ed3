"""Secret scans over an incremental ledger of content-addressed blobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# fixed values: kind, version, pattern, the group that must be long enough, its least length.
_KEYWORDS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + \
    _either_case("api") + "_?" + _either_case("key")
BASE_RULES = (
    ("assign", 1, f"({_KEYWORDS})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", 1, "AKIA[A-Z0-9]+", 0, 20),
    ("hex", 1, "[0-9a-f]+", 0, 24),
)
MORE_RULES = (
    ("pem", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("jwt", 1, "eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 0, 40),
)
# end of fixed values
RULES = BASE_RULES + MORE_RULES
# A run of fewer characters than the least length can't match: the filter that most texts don't pass.
_QUICK = {"hex": "[0-9a-f]{24}", "access": "AKIA[A-Z0-9]{16}"}

LEDGER = "blob binary, rule string, version int, spans array<struct<start:int,end:int>>"


def match_spans(text: Column, pattern: str, group: int, least: int) -> Column:
    """Code-point spans (end exclusive) of leftmost, non-overlapping matches whose group is long enough.

    The pieces between the matches and the matches themselves add up to the places; a match that fails
    the length still uses up its text, as in a scan from left to right.
    """
    rows = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("before"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x)).alias("size"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: F.length(x)).alias("held"))
    nothing = F.array().cast("array<struct<start:int,end:int>>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["before"]
        end = start + F.coalesce(x["size"], F.lit(0))
        return F.struct(end.alias("at"), F.when(
            x["held"] >= least, F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end")))))
            .otherwise(state["spans"]).alias("spans"))

    found = F.aggregate(rows, F.struct(F.lit(0).alias("at"), nothing.alias("spans")), step, lambda s: s["spans"])
    return found


def blob_of(text: Column) -> Column:
    """The content address: SHA-256 of the text's bytes; a null text is the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _rule_name(rule: tuple) -> str:
    return f"{rule[0]}@{rule[1]}"


def scan_blobs(blobs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """Ledger rows of the blobs (blob, text, todo: rule@version names to run): one per blob and rule."""
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    text = F.col("text")
    rows = F.array(*[F.struct(
        F.lit(kind).alias("rule"), F.lit(version).alias("version"),
        F.when(F.array_contains("todo", f"{kind}@{version}") & text.rlike(_QUICK.get(kind, pattern)),
               match_spans(text, pattern, group, least)).otherwise(nothing).alias("spans"))
        for kind, version, pattern, group, least in rules])
    found = blobs.select("blob", "todo", F.explode(rows).alias("r")).where(
        F.array_contains("todo", F.concat_ws("@", "r.rule", "r.version")))
    return found.select("blob", "r.rule", "r.version", "r.spans")


def unseen_blobs(docs: DataFrame, seen: DataFrame | None, rules: tuple = RULES, text: str = "text") -> DataFrame:
    """Each distinct content once, with the rules (at their versions) that the ledger doesn't hold for it."""
    rows = docs.select(blob_of(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    wanted = F.array(*[F.lit(_rule_name(r)) for r in rules])
    if seen is None:
        return rows.groupBy("blob").agg(F.first("text").alias("text")).withColumn("todo", wanted)
    known = seen.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", "version")).alias("done"))
    rows = rows.join(known, "blob", "left").withColumn(
        "todo", F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>"))))
    return rows.where(F.size("todo") > 0).groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(LEDGER).parquet(ledger)


def update_ledger(docs: DataFrame, ledger: str, rules: tuple = RULES, text: str = "text") -> DataFrame:
    """Scan what the ledger (a Parquet folder in shared storage) hasn't seen, append it, and return the ledger.

    Appending is all or nothing for a job, and a repeated run scans nothing again.
    """
    spark = docs.sparkSession
    scan_blobs(unseen_blobs(docs, read_ledger(spark, ledger), rules, text), rules).write.mode("append").parquet(ledger)
    return spark.read.schema(LEDGER).parquet(ledger)


def findings(docs: DataFrame, ledger: DataFrame, rules: tuple = RULES, text: str = "text") -> DataFrame:
    """Findings joined back to all rows ("paths") of ``docs``: every column plus ``secrets``.

    ``secrets`` is an array of (start, kind_no, kind, end) sorted by start, then by the kind's place in
    ``rules``; empty where nothing was found. Rows with no finding never meet a large key: only blobs
    with findings are joined, and the join's hot blobs are split by adaptive execution.
    """
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(_rule_name(r)), F.lit(i))])
    found = ledger.where(F.size("spans") > 0).withColumn("no", order[F.concat_ws("@", "rule", "version")]).where(
        "no is not null").select("blob", "rule", "version", "spans", "no").dropDuplicates(["blob", "no"])
    found = found.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), F.col("no").alias("kind_no"), F.col("rule").alias("kind"),
        s["end"].alias("end")))))).alias("secrets"))
    nothing = F.array().cast("array<struct<start:int,kind_no:int,kind:string,end:int>>")
    rows = docs.withColumn("__blob", blob_of(F.col(text)))
    return rows.join(found.withColumnRenamed("blob", "__found"), F.col("__blob") == F.col("__found"), "left").drop(
        "__blob", "__found").withColumn(
        "secrets", F.coalesce("secrets", nothing))


def scan_secrets(docs: DataFrame, ledger: str, rules: tuple = RULES, text: str = "text") -> DataFrame:
    """Find secrets in every row of ``docs``: ``update_ledger``, then ``findings``.

    Every text, of whatever version of a path, is addressed by its content; only unseen pairs of a
    blob and a rule version are scanned, each content once. A null text counts as the empty text. An
    empty text or table has no finding. Repeated rows all get their findings. Columns of ``docs`` stay,
    but an input column named ``secrets`` is replaced. Long texts are scanned whole.
    """
    return findings(docs.drop("secrets"), update_ledger(docs, ledger, rules, text), rules, text)


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replace each span of ``secrets`` in the text by ``mark``; overlapping spans become one mark."""
    body = F.col(text)

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], F.substring(body, state["at"] + 1, s["start"] - state["at"]),
                                   F.lit(mark))).otherwise(state["out"]).alias("out"))

    made = F.aggregate("secrets", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda s: F.concat(s["out"], F.substring(body, s["at"] + 1, F.length(body))))
    return docs.withColumn(text, F.when(F.size("secrets") > 0, made).otherwise(body))


def span_text(secrets: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of the spans, comma-joined."""
    if kinds is not None:
        secrets = F.filter(secrets, lambda s: reduce(lambda a, b: a | b, [s["kind"] == k for k in kinds]))
    return F.concat_ws(",", F.transform(secrets, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
