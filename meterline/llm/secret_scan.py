"""Secret scans over a ledger of content-addressed blobs: each blob is scanned once for each version of the rules."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.tables import boxed, read, shared_folder, with_field

#: kind, pattern, group whose length counts, fewest characters of it. The first three are the base kinds.
#: Runs of one class of signs are matched with their least length in the pattern: shorter runs can't hold a match.
#: A private key runs to its END, or, where that is missing, to the end of its base64 lines; between them may stand breaks (also
#: escaped), signs of quoting, and headers. A last line may be short. All repeats but {0,40} give nothing back, so no text is slow.
_BEGIN, _END = (rf"-----{x} [A-Z ]{{0,40}}PRIVATE KEY-----" for x in ("BEGIN", "END"))
_GAP = r"""(?:[\s"',>|#*]|\\[nrt]|\+(?=\s))"""
_HEADERS = rf"""(?:{_GAP}++(?:Proc-Type|DEK-Info):\x20?[^\s\\"']++)*+"""
_LAST = rf"""(?:{_GAP}++[A-Za-z0-9+/]++(?:={{1,2}}+|(?=["',]*+[\x20\t]*+(?:\\[nr]|(?![^\r\n])))))?+"""
_LINES = rf"(?:(?:{_GAP}*+[A-Za-z0-9+/]{{16,}}+={{0,2}}+)++{_LAST})?+"
RULES = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("private_key", rf"{_BEGIN}(?:(?:[^-]++|-{{1,4}}+(?!-))*+{_END}|{_HEADERS}{_LINES})", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 1),
    ("vendor", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})", 0, 1),
]
#: Changes with any rule, so a ledger never passes off what old rules found.
RULES_VERSION = hashlib.sha256(repr(RULES).encode()).hexdigest()[:16]
BASE = 3
SALTS = 8
SPAN = "array<struct<start:int,kind:int,stop:int>>"


def running(values, start, join):
    """For each place of an array what join makes of all values up to it: each round joins twice as many as the one before."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + 1)).cast("int"))
    step = lambda acc, k: F.transform(acc, lambda x, i: join(x, F.coalesce(F.get(acc, i - F.pow(F.lit(2), k).cast("int")), F.lit(start))))
    return F.aggregate(rounds, values, step)


def _spans(text, kind: int, pattern: str, group: int, least: int):
    """Leftmost non-overlapping matches as (start, kind, end) in code points: lengths of what lies between give the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(found, F.char_length)
    counted = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.char_length) if group else sizes
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    stops = running(F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), sizes, lambda gap, n: gap + n), 0, lambda a, b: a + b)
    each = F.arrays_zip(stops.alias("stop"), sizes.alias("n"), counted.alias("counted"))
    spans = F.transform(F.filter(each, lambda m: m["counted"] >= least), lambda m: F.struct((m["stop"] - m["n"]).alias("start"), F.lit(kind).alias("kind"), m["stop"].alias("stop")))
    return F.when(text.rlike(pattern), spans).otherwise(F.expr(f"CAST(array() AS {SPAN})"))


def address(text):
    """The content address of a text: its SHA-256; a null text is the empty blob."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan(blobs: DataFrame, rules_version: str = RULES_VERSION) -> DataFrame:
    """Ledger rows (blob, rules_version, spans) for (blob, text) rows; spans by start, then kind, are empty where nothing is found."""
    spans = F.concat(*[_spans(F.col("text"), k, pattern, group, least) for k, (_, pattern, group, least) in enumerate(RULES)])
    return blobs.select("blob", F.lit(rules_version).alias("rules_version"), F.array_sort(spans).alias("spans"))


class Ledger:
    """What was found in which blob under which rules, in a folder that grows by whole files.

    A row that was appended twice, by a repeated run say, counts once.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
        self.schema = f"blob string, rules_version string, spans {SPAN}"
        self.append(spark.range(0).selectExpr("CAST(NULL AS string) AS blob", "CAST(NULL AS string) AS rules_version", f"CAST(NULL AS {SPAN}) AS spans"))

    def append(self, rows: DataFrame) -> None:
        rows.select("blob", "rules_version", "spans").write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def under(self, rules_version: str) -> DataFrame:
        return self.rows().where(F.col("rules_version") == rules_version).dropDuplicates(["blob"])


def unseen(paths: DataFrame, ledger: Ledger, rules_version: str = RULES_VERSION) -> DataFrame:
    """(blob, text), one for each text in paths that the ledger doesn't have under this version of the rules."""
    blobs = paths.select(address(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    return blobs.join(ledger.under(rules_version).select("blob"), "blob", "left_anti").groupBy("blob").agg(F.first("text").alias("text"))


def findings(paths: DataFrame, ledger: Ledger | None = None, rules_version: str = RULES_VERSION) -> DataFrame:
    """(row, blob, spans) for each row of paths, a struct of all its columns; new blobs are scanned and put on the ledger first.

    Equal texts share one blob and one scan, however many paths or historical versions hold them. What is found goes back to
    all paths by a join on the blob and a salt, so a text that very many paths hold meets in several tasks. A null text counts as empty. Very
    long texts are scanned whole, in time that grows with length and, but for a logarithm, with the number of matches.
    Repeated rows each get what is found. An empty table gives no rows, and puts none on the ledger.
    """
    ledger = ledger or Ledger(paths.sparkSession)
    ledger.append(scan(unseen(paths, ledger, rules_version), rules_version))
    found = ledger.under(rules_version).where(F.size("spans") > 0).select("blob", "spans", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    named = boxed(paths).withColumn("blob", address(F.col("row.text"))).withColumn("salt", F.spark_partition_id() % SALTS)
    back = named.join(found, ["blob", "salt"], "left")
    return back.select("row", "blob", F.coalesce("spans", F.expr(f"CAST(array() AS {SPAN})")).alias("spans"))


def scan_versions(paths: DataFrame, ledger: Ledger | None = None, rules_version: str = RULES_VERSION) -> DataFrame:
    """paths (any columns and text) with blob and spans for every row, as findings() has it; columns of paths with these two names are replaced."""
    return findings(paths, ledger, rules_version).select(*[F.col(f"row.`{c}`") for c in paths.columns if c not in ("blob", "spans")], "blob", "spans")


def digest(spans):
    names = F.array(*[F.lit(name) for name, *_ in RULES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


CHUNK = 1024


def redact(text, spans, mark: str = "[SECRET]"):
    """text with every span (by start; overlapping ones as one) replaced by mark.

    The text is cut into chunks, so what lies between two spans is found without going through all that is before it.
    Chunks and the running ends of spans are bound by an array of one, so they are made once and not for each span.
    """
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    stops = running(F.transform(spans, lambda s: s["stop"]), 0, lambda a, b: F.greatest(a, b))
    # each span with the end of all before it, and one more at the end of the text
    after = F.transform(spans, lambda s: s["start"])
    gaps = F.arrays_zip(F.concat(F.array(F.lit(0)), stops).alias("begin"), F.concat(after, F.array(F.char_length(text))).alias("end"))

    def joined(x):
        def piece(gap, i):
            first = F.floor(gap["begin"] / CHUNK).cast("int")
            part = F.array_join(F.slice(x["chunks"], first + 1, F.floor(gap["end"] / CHUNK).cast("int") - first + 1), "")
            between = F.substr(part, gap["begin"] - first * CHUNK + 1, gap["end"] - gap["begin"])
            last = i == F.size(x["gaps"]) - 1
            return F.when(gap["end"] >= gap["begin"], F.concat(between, F.when(last, F.lit("")).otherwise(F.lit(mark)))).otherwise(F.lit(""))

        return F.array_join(F.transform(x["gaps"], piece), "")

    return F.get(F.transform(F.array(F.struct(chunks.alias("chunks"), gaps.alias("gaps"))), joined), F.lit(0))


def redact_documents(docs: DataFrame, ledger: Ledger | None = None) -> DataFrame:
    """docs with every secret replaced by a mark, in its own columns; n_chars follows where there is one.

    Rows without secrets, null and empty texts among them, stay as they are, and so do all other columns, whatever
    their names. Repeated rows and ids are treated alike; an empty table gives no rows. Very long texts are scanned and
    marked whole, in linear time.
    """
    found = findings(docs, ledger)
    odd = F.size("spans") > 0
    text = F.when(odd, redact(F.col("row.text"), F.col("spans"))).otherwise(F.col("row.text"))
    changed = found.withColumn("row", with_field(docs, F.col("row"), "text", text))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("row", with_field(docs, F.col("row"), "n_chars", F.when(odd, F.char_length("row.text")).otherwise(F.col("row.n_chars"))))
    return changed.select("row.*")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = scan_versions(read(spark, sf_dir, "documents").select("doc_id", "text"))
    back = back.withColumn("base", F.filter("spans", lambda s: s["kind"] < BASE))
    return back.select(
        "doc_id",
        *[F.expr(f"CAST(size(filter(base, s -> s.kind = {k})) AS BIGINT)").alias(f"n_{RULES[k][0]}") for k in range(BASE)],
        F.sha2(digest(F.col("base")), 256).alias("base_sha256"),
        digest(F.col("spans")).alias("spans"),
    )
