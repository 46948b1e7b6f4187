"""The processed feature table: immutable parts, and snapshots that name the parts that make up the table.

A snapshot is a small file that is never changed.  Writers add parts and then the next snapshot, which one of several
writers can create; readers take the newest.  So a reader always finds a whole table, a writer that fails leaves the table as
it was, and a writer that was overtaken is told so.

A day's run adds a part with the rows of that day.  Products whose earlier rows change with it (a late sale, a first sale) come
with all their rows, and are named as rewritten: their rows in earlier parts are no longer read.  ``write_features``
puts a single part in place of all of them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.sources import files

KEPT_SNAPSHOTS = 5
"""Parts of this many snapshots stay on disk, for readers that opened the table a while ago."""


class Overtaken(RuntimeError):
    """Another writer has replaced the snapshot this one started from."""


@dataclass(frozen=True)
class Snapshot:
    """Parts oldest first, the rewritten products of each (or None), the table's schema, and the lifecycle state."""

    parts: list[str]
    rewritten: list[str | None]
    schema: dict
    state: str | None = None
    number: int = field(default=0, compare=False)


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/_snapshots"


def newest(spark: SparkSession, path: str) -> Snapshot | None:
    numbers = files.versions(spark, _folder(path))
    if not numbers:
        return None
    return Snapshot(**json.loads(files.read_text(spark, files.version_path(_folder(path), numbers[-1]))) | {"number": numbers[-1]})


def _publish(spark: SparkSession, path: str, snapshot: Snapshot, after: int) -> None:
    content = {name: value for name, value in asdict(snapshot).items() if name != "number"}
    if not files.create_once(spark, files.version_path(_folder(path), after + 1), json.dumps(content)):
        raise Overtaken(f"{path} has a newer snapshot than {after}; read it again and repeat the write")
    _expire(spark, path, KEPT_SNAPSHOTS)


def _expire(spark: SparkSession, path: str, keep: int) -> None:
    """Remove the oldest snapshots, and the parts that no other one names.

    Parts that no snapshot names at all may belong to a writer that is not done, so they are left alone.
    """
    old = files.versions(spark, _folder(path))[:-keep]
    if not old:
        return
    loaded = {n: Snapshot(**json.loads(files.read_text(spark, files.version_path(_folder(path), n))))
              for n in files.versions(spark, _folder(path))}

    def named(numbers) -> set[str]:
        return {name for n in numbers for name in (*loaded[n].parts, *loaded[n].rewritten, loaded[n].state) if name}

    for name in named(old) - named(set(loaded) - set(old)):
        files.remove(spark, f"{path.rstrip('/')}/{name}")
    for n in old:
        files.remove(spark, files.version_path(_folder(path), n))


def _write(df: DataFrame, path: str, kind: str) -> str:
    name = f"{kind}/{uuid.uuid4().hex}"
    df.write.parquet(f"{path.rstrip('/')}/{name}")
    return name


def _in_date_order(features: DataFrame) -> DataFrame:
    """Readers ask for dates: the evaluation window, the look-back.  Each task therefore writes its
    products in date order, a local sort, so that a date filter skips most row groups."""
    return features.sortWithinPartitions("date", "product_id")


def write_features(features: DataFrame, path: str, state: DataFrame | Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Replace the stored features, and the lifecycle state that goes with them.  Runs a job; every task writes its own files.

    ``state`` may be made from the features as they were written.
    """
    spark = features.sparkSession
    before = newest(spark, path)
    part = _write(_in_date_order(features), path, "parts")
    if callable(state):
        state = state(spark.read.schema(features.schema).parquet(f"{path.rstrip('/')}/{part}"))
    _publish(spark, path, Snapshot([part], [None], json.loads(features.schema.json()),
                                   None if state is None else _write(state, path, "states")), before.number if before else 0)


def append_features(rows: DataFrame, rewritten: DataFrame, state: DataFrame, path: str, base: Snapshot) -> None:
    """Add a run's rows to the snapshot ``base``.  ``rewritten`` (product_id) names products whose earlier rows they replace."""
    spark = rows.sparkSession
    known = T.StructType.fromJson(base.schema)
    if sorted(f.name for f in known) != sorted(rows.columns):
        raise ValueError("the columns differ from the stored features'; build them anew")
    added = _write(_in_date_order(rows.select(*[F.col(f.name).cast(f.dataType) for f in known])), path, "parts")
    replaced = _write(rewritten.select("product_id"), path, "rewritten")
    _publish(spark, path, Snapshot([*base.parts, added], [*base.rewritten, replaced], base.schema, _write(state, path, "states")),
             base.number)


def read_features(spark: SparkSession, path: str, snapshot: Snapshot | None = None) -> DataFrame:
    """The features of the newest snapshot, or of one that was opened before."""
    snapshot = snapshot or newest(spark, path)
    if snapshot is None:
        raise FileNotFoundError(f"no features were written to {path}")
    root, schema = path.rstrip("/"), T.StructType.fromJson(snapshot.schema)
    lists = [(number, name) for number, name in enumerate(snapshot.rewritten) if name]
    if not lists:
        return spark.read.schema(schema).parquet(*[f"{root}/{part}" for part in snapshot.parts])
    key = T.StructType([schema["product_id"]])
    replaced = reduce(DataFrame.union, [
        spark.read.schema(key).parquet(f"{root}/{name}").withColumn("from_part", F.lit(number)) for number, name in lists])
    # One row for each product that was ever rewritten; Spark broadcasts them while they are few.
    last = replaced.groupBy("product_id").agg(F.max("from_part").alias("from_part"))
    rows = reduce(DataFrame.union, [
        spark.read.schema(schema).parquet(f"{root}/{part}").withColumn("part", F.lit(number)) for number, part in enumerate(snapshot.parts)])
    return rows.join(last, "product_id", "left").where(
        F.col("from_part").isNull() | (F.col("part") >= F.col("from_part"))).select(*schema.names)


def read_state(spark: SparkSession, path: str, snapshot: Snapshot) -> DataFrame | None:
    """The lifecycle state that was written with a snapshot."""
    return spark.read.parquet(f"{path.rstrip('/')}/{snapshot.state}") if snapshot.state else None
