"""Payloads whose parts stand in blobs: references are put back in, leaves first, each blob once."""

from __future__ import annotations

import base64
import gzip
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions import json_text
from meterline.functions.json_text import JsonProblem, Rendered
from meterline.operators.ancestry import circular
from meterline.sources.tables import written

#: Fixed value: arrays, objects and blobs of JSON inside each other at most.
DEEPEST = 64
#: An expanded payload has so many bytes at most: blobs that name another twice grow twofold a level.
LARGEST = 256 << 20
ENCODINGS = ("raw", "utf8", "data-url", "json")
#: Why a text is not whole, the first that holds.
PROBLEMS = ("not JSON", "repeated key", "number out of range", "too deep", "too large", "cycle", "unsupported encoding", "bad blob", "absent")
REFS = "array<struct<hash:string,encoding:string>>"
HELD = "array<struct<hash:string,there:boolean,body:binary,json:string,depth:int,problem:string>>"
REWRITTEN = "id string, json string, depth int, problem string"


def _worst(problems: list[str | None]) -> str | None:
    found = [p for p in problems if p]
    return min(found, key=PROBLEMS.index) if found else None


def _references(value, mark: str, out: set[tuple[str, str]]) -> None:
    if isinstance(value, dict):
        if isinstance(value.get(mark), str):
            encoding = value.get("encoding")
            out.add((value[mark], encoding if isinstance(encoding, str) else ""))
            return
        value = value.values()
    elif not isinstance(value, list):
        return
    for item in value:
        _references(item, mark, out)


def _decoded(body: bytes, codec: str | None) -> bytes | None:
    try:
        return gzip.decompress(body) if codec == "gzip" else body
    except (OSError, EOFError, zlib.error):
        return None


def _expanded(value, mark: str, held: dict[str, dict], problems: list[str | None]) -> tuple[object, int]:
    """A value with its references put in, and how many levels are inside it. What can't be put in stays, and problems says why."""
    if isinstance(value, list):
        parts = [_expanded(v, mark, held, problems) for v in value]
        return [p for p, _ in parts], max((d + 1 for _, d in parts), default=0)
    if not isinstance(value, dict):
        return value, 0
    if not isinstance(value.get(mark), str):
        parts = {k: _expanded(v, mark, held, problems) for k, v in value.items()}
        return {k: p for k, (p, _) in parts.items()}, max((d + 1 for _, d in parts.values()), default=0)
    encoding, blob = value.get("encoding"), held[value[mark]]
    if encoding not in ENCODINGS:
        problems.append("unsupported encoding")
    elif not blob["there"]:
        problems.append("absent")
    elif encoding == "json" and blob["problem"] and blob["json"] is None:
        problems.append(blob["problem"])
    elif blob["body"] is None:
        problems.append("bad blob")
    elif encoding == "data-url":
        media = value.get("media_type")
        return f"data:{media if isinstance(media, str) else ''};base64,{base64.b64encode(blob['body']).decode()}", 0
    elif encoding in ("raw", "utf8"):
        return blob["body"].decode(errors="replace"), 0
    elif blob["json"] is not None:  # it has been expanded itself, perhaps with references that stay
        problems.append(blob["problem"])
        return Rendered(blob["json"]), blob["depth"] + 1
    else:
        try:
            leaf = json_text.parse(blob["body"].decode(errors="replace"))
            return leaf, _levels(leaf) + 1
        except JsonProblem:
            problems.append("bad blob")
    return value, _levels(value)


def _levels(value) -> int:
    inside = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return max((_levels(v) + 1 for v in inside), default=0)


def _rewritten(text: str | None, held: list[dict], mark: str, whole_raw: bool, deepest: int) -> tuple[str | None, int, str | None]:
    """(JSON, levels, problem) of a text. A text that is nothing but a reference to raw bytes is what these bytes say, as JSON if they are JSON."""
    if text is None:
        return None, 0, None
    problems: list[str | None] = []
    try:
        value = json_text.parse(text)
        out, depth = _expanded(value, mark, {h["hash"]: h for h in held}, problems)
        if whole_raw and isinstance(value, dict) and value.get("encoding") == "raw" and isinstance(out, str):
            try:
                out = json_text.parse(out)
                depth = _levels(out)
            except JsonProblem:
                pass
        if depth > deepest:
            return None, depth, "too deep"
        made = json_text.write(out)
    except JsonProblem as error:
        return None, 0, str(error)
    except RecursionError:
        return None, 0, "too deep"
    if len(made) > LARGEST:
        return None, depth, "too large"
    worst = _worst(problems)
    return (None if worst in ("too deep", "too large") else made), depth, worst


def _with_references(texts: DataFrame, mark: str) -> DataFrame:
    """(id, text) with refs: each reference of the text once; none where it is no JSON."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                out: set[tuple[str, str]] = set()
                if text and mark in text:
                    try:
                        _references(json_text.parse(text), mark, out)
                    except (JsonProblem, RecursionError):
                        out = set()
                found.append([{"hash": h, "encoding": e} for h, e in sorted(out)])
            refs = pa.array(found, pa.list_(pa.struct([("hash", pa.string()), ("encoding", pa.string())])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text"), refs], ["id", "text", "refs"])

    return texts.select("id", "text").mapInArrow(run, f"id string, text string, refs {REFS}")


def _put_in(texts: DataFrame, values: DataFrame, mark: str, whole_raw: bool, deepest: int) -> DataFrame:
    """REWRITTEN of texts (id, text, refs) with values (hash, body, json, depth, problem) for what they refer to."""
    asked = texts.select("id", F.explode(F.array_distinct(F.transform("refs", lambda r: r["hash"]))).alias("hash"))
    found = asked.join(values.withColumn("there", F.lit(True)), "hash", "left")
    entry = F.struct("hash", F.coalesce("there", F.lit(False)).alias("there"), "body", "json", "depth", "problem")
    held = found.groupBy("id").agg(F.collect_list(entry).cast(HELD).alias("held"))  # what one text refers to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):  # texts may be large, so one at a time is put out
                i, text, own = (batch.column(c)[row].as_py() for c in ("id", "text", "held"))
                made = (i, *_rewritten(text, own or [], mark, whole_raw, deepest))
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(made, (pa.string(), pa.string(), pa.int32(), pa.string()))], ["id", "json", "depth", "problem"])

    return texts.join(held, "id", "left").select("id", "text", "held").mapInArrow(run, REWRITTEN)


def _bodies(blobs: DataFrame) -> DataFrame:
    """(hash, body): blobs (hash, codec, body) with gzip undone; null where that fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [None if b is None else _decoded(b, c) for c, b in zip(batch.column("codec").to_pylist(), batch.column("body").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("hash"), pa.array(bodies, pa.binary())], ["hash", "body"])

    return blobs.select("hash", "codec", "body").mapInArrow(run, "hash string, body binary")


def expand_blobs(rows: DataFrame, blobs: DataFrame, mark: str = "$blob", deepest: int = DEEPEST) -> DataFrame:
    """(id, text, complete, problem): the JSON text of rows (id, text) in canonical form, with every object {"<mark>": hash, "encoding": ...} replaced by what
    its blob (hash, codec, body) holds; codec is gzip or anything else for none.

    raw and utf8 give the text (bytes that are no UTF-8 are replaced), data-url a URL with the object's media_type, json the value itself,
    in which references are replaced, too. Blobs with references are put together from the leaves up, each once: a round takes those whose own
    references of JSON are all done, writes them down, and takes them out of the edges that are left. So there are as many rounds as
    blobs lie in each other, up to `deepest`; those left over are in or above a cycle, or too deep. What a round takes and needs is written down as a table of
    known size: where that is small, it meets all blobs without a shuffle of them.

    What can't be put in stays as it is, and complete is false: problem is the first of PROBLEMS. Text is null where it is no
    strict JSON, has more than `deepest` levels with its blobs, or is longer than LARGEST. A null text stays null and is complete. ids are distinct;
    equal hashes are one blob. The session needs a checkpoint folder.
    """
    spark = rows.sparkSession
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/blobs-{uuid.uuid4().hex}"
    kind = rows.schema["id"].dataType
    bodies = written(_bodies(blobs.dropDuplicates(["hash"])))
    inner = bodies.where(F.contains("body", F.encode(F.lit(mark), "UTF-8"))).select(F.col("hash").alias("id"), F.decode("body", "UTF-8").alias("text"))
    inner = written(_with_references(inner, mark).where(F.size("refs") > 0))
    leaves = bodies.withColumns({"json": F.lit(None).cast("string"), "depth": F.lit(0), "problem": F.lit(None).cast("string")})
    edges = inner.select("id", F.explode("refs").alias("ref")).where("ref.encoding = 'json'").select("id", F.col("ref.hash").alias("to"))
    edges = written(edges.join(inner.select(F.col("id").alias("to")), "to", "left_semi").distinct())
    schema = "hash string, json string, depth int, problem string"

    def done(rounds: int) -> DataFrame:
        return spark.read.schema(schema).parquet(*[f"{folder}/{k}" for k in range(rounds)]) if rounds else spark.createDataFrame([], schema)

    n, ready = 0, written(inner.select("id").join(edges.select("id"), "id", "left_anti"))
    while n <= deepest and not ready.isEmpty():
        texts = inner.join(ready, "id", "left_semi")
        needed = written(texts.select(F.explode("refs.hash").alias("hash")).distinct())
        some = lambda values: values.join(needed, "hash", "left_semi")
        made = _put_in(texts, _values(some(leaves), some(done(n))), mark, False, deepest)
        made.select(F.col("id").alias("hash"), "json", "depth", "problem").write.parquet(f"{folder}/{n}")
        n += 1
        over = ready.select(F.col("id").alias("to"))
        touched = written(edges.join(over, "to", "left_semi").select("id").distinct())
        edges = written(edges.join(over, "to", "left_anti"))
        ready = written(touched.join(edges.join(touched, "id", "left_semi").select("id"), "id", "left_anti"))
    left = written(inner.select("id").join(done(n).select(F.col("hash").alias("id")), "id", "left_anti"))
    if not left.isEmpty():
        above = circular(edges.select(F.col("id").alias("from_id"), F.col("to").alias("to_id"))).withColumn("problem", F.lit("cycle"))
        rest = left.join(above, "id", "left").select(F.col("id").alias("hash"), F.lit(None).cast("string").alias("json"), F.lit(0).alias("depth"), F.coalesce("problem", F.lit("too deep")).alias("problem"))
        rest.write.parquet(f"{folder}/{n}")
        n += 1
    texts = _with_references(rows.select(F.col("id").cast("string").alias("id"), "text"), mark)
    out = _put_in(texts, _values(leaves, done(n)), mark, True, deepest)
    return out.select(F.col("id").cast(kind).alias("id"), F.col("json").alias("text"), F.col("problem").isNull().alias("complete"), "problem")


def _values(leaves: DataFrame, done: DataFrame) -> DataFrame:
    """Blobs with what has become of those that hold references."""
    new = done.toDF("hash", "_json", "_depth", "_problem").withColumn("_done", F.lit(True))
    pick = lambda c: F.when(F.col("_done"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
    return leaves.join(new, "hash", "left").select("hash", "body", *[pick(c) for c in ("json", "depth", "problem")])
