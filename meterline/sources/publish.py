"""Tables whose days are replaced as a whole: files are written aside, a manifest comes last, and readers see published files alone.

Under root, data/version=<id>/<day>=<n>/ holds files and manifests/<sequence>.json says which version each day is read from. A manifest is
written under another name and renamed, which fails if that sequence is there: of two writers that began at the same state one is
refused. A writer that dies before leaves files that no manifest names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from meterline.operators.graph import digest_sums, digest_text


def _hadoop(spark: SparkSession, path: str):
    """Path class and file context for a path, in whatever store it is."""
    fs = spark._jvm.org.apache.hadoop.fs
    at = fs.Path(path)
    return fs, fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())


def put_new(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file in one step: it is there whole or not at all. A file of that name is an error."""
    fs, context = _hadoop(spark, path)
    aside = fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    context.mkdir(aside.getParent(), None, True)
    create = spark._jvm.java.util.EnumSet.of(fs.CreateFlag.CREATE)
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$CreateOpts"), 0)
    out = context.create(aside, create, options)
    out.write(text.encode())
    out.close()
    none = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    none[0] = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename").NONE
    try:
        context.rename(aside, fs.Path(path), none)
    except Exception as error:
        context.delete(aside, False)
        if "FileAlreadyExists" in str(error):
            raise FileExistsError(path) from None
        raise


def current(spark: SparkSession, root: str) -> dict:
    """The last manifest; sequence 0 and no days where nothing is published."""
    fs, context = _hadoop(spark, root)
    found = context.util().globStatus(fs.Path(f"{root}/manifests/*.json"))
    names = sorted(f.getPath().toString() for f in found or [])
    if not names:
        return {"sequence": 0, "days": {}, "prior": None}
    return json.loads(spark.read.text(names[-1], wholetext=True).head().value)


def observed(rows: DataFrame, session: str | None = None, fence: str | None = None) -> tuple[DataFrame, Observation]:
    """rows with counters that come with whatever action runs on them: rows, an order-free digest, and, where named, sessions and the highest fence.

    Distinct sessions can't be observed, so each session's first row is marked; that sorts rows by session.
    """
    counters = Observation(f"rows-{uuid.uuid4().hex}")
    digest = F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256)
    told = [F.count("*").alias("rows"), *digest_sums(digest)]
    columns = rows.columns
    if fence:
        told.append(F.max(fence).alias("fence"))
    if session:
        first = F.row_number().over(Window.partitionBy(session).orderBy(session)) == 1
        rows = rows.withColumn("_first", first)
        told.append(F.count_if("_first").alias("sessions"))
    return rows.observe(counters, *told).select(*columns), counters


def counted(counters: Observation) -> dict:
    """What observed() counted, after the action."""
    got = counters.get
    return {k: got[k] for k in ("rows", "sessions", "fence") if k in got} | {"digest": digest_text([got[f"_s{i}"] for i in range(8)])}


def publish_days(rows: DataFrame, root: str, day: str, days: list[int] | None = None) -> dict:
    """Replaces whole days of the table at root by rows and returns the new manifest. days: those replaced, rows' own if None; a day without rows goes.

    Rows are read once: counters come with the write.
    """
    spark = rows.sparkSession
    before, version = current(spark, root), uuid.uuid4().hex
    out, counters = observed(rows)
    out.repartition(day).write.partitionBy(day).parquet(f"{root}/data/version={version}")
    told = counted(counters)
    fs, context = _hadoop(spark, root)
    found = context.util().globStatus(fs.Path(f"{root}/data/version={version}/{day}=*"))
    own = {f.getPath().getName().split("=", 1)[1] for f in found or []}
    if days is not None and own - set(map(str, days)):
        raise ValueError(f"rows of days that are not replaced: {sorted(own - set(map(str, days)))[:5]}")
    kept = {d: v for d, v in before["days"].items() if d not in own and d not in set(map(str, days or ()))}
    manifest = {"sequence": before["sequence"] + 1, "prior": before.get("digest"), "version": version, **told, "days": dict(sorted((kept | dict.fromkeys(own, version)).items()))}
    put_new(spark, f"{root}/manifests/{manifest['sequence']:010d}.json", json.dumps(manifest))
    return manifest


def published(spark: SparkSession, root: str, schema: str | StructType, day: str) -> DataFrame:
    """What the last manifest names, under a schema that has the day. Files of days that were replaced, and of writers that never came to their manifest, are left out."""
    kind = schema if isinstance(schema, StructType) else DataType.fromDDL(schema)
    days = current(spark, root)["days"]
    if not days:
        return spark.createDataFrame([], kind)
    files = StructType([*kind.fields, StructField("version", StringType())])
    rows = spark.read.schema(files).option("basePath", f"{root}/data").parquet(*[f"{root}/data/version={v}" for v in sorted(set(days.values()))])
    live = spark.createDataFrame([(int(d), v) for d, v in days.items()], StructType([StructField(day, LongType()), StructField("version", StringType())]))  # a row a day
    return rows.join(live, [day, "version"], "left_semi").select(*kind.names)


def overwrite_days(rows: DataFrame, path: str, day: str) -> None:
    """Replaces the days that rows have in a plain table partitioned by day; other days' files aren't touched. Readers may see it half done."""
    rows.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def rebuild(facts: DataFrame, candidates: DataFrame, root: str, day: str, aggregate: Callable[[DataFrame], DataFrame]) -> dict:
    """Works the days of all candidates out anew from facts and publishes them; without candidates nothing changes. Both have the day.

    The days that candidates touch come to the driver: as many as the calendar has.
    """
    touched = candidates.select(day).distinct()
    days = [r[0] for r in touched.collect()]
    if not days:
        return current(facts.sparkSession, root)
    return publish_days(aggregate(facts.join(touched, day, "left_semi")), root, day, days)
