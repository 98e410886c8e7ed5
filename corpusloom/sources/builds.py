"""Builds by shard that resume, rebuild when their options change, and are published whole.

A build is a table made of shards, each written by a job of its own. Below ``root``:

* ``data/<unique name>``: the rows of one finished or broken attempt at one shard; never written twice;
* ``log``: JSON lines, one small file for each entry, which appears whole or not at all.

A log entry says that a shard is finished, under which fingerprint of the options and where, or that a build is
published, which is written once all of its shards are. Readers go by the last published build and the
shards it names, so they never meet a half-written table, not even while the next build replaces it.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "kind STRING, fingerprint STRING, build STRING, shard STRING, path STRING, at DOUBLE, shards ARRAY<STRING>, schema STRING"


def options_fingerprint(options: Mapping) -> str:
    """A hash of build options: any JSON values, whatever the order of their names."""
    return hashlib.sha256(json.dumps(options, sort_keys=True, default=str).encode()).hexdigest()


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """All entries so far; none where nothing was ever built."""
    try:
        return spark.read.schema(LOG).json(f"{root.rstrip('/')}/log")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def _append(spark: SparkSession, root: str, **entry) -> None:
    row = spark.createDataFrame([tuple(entry.get(f.name) for f in T._parse_datatype_string(LOG).fields)], LOG)
    row.coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/log")


def finished_shards(spark: SparkSession, root: str, fingerprint: str) -> dict[str, tuple[str, str]]:
    """(path, schema) of each shard finished under these options; of several attempts the last."""
    done = read_log(spark, root).where((F.col("kind") == "shard") & (F.col("fingerprint") == fingerprint))
    last = done.groupBy("shard").agg(F.max_by(F.struct("path", "schema"), F.struct("at", "path")).alias("last"))
    return {r["shard"]: tuple(r["last"]) for r in last.collect()}


def build_shards(
    spark: SparkSession, root: str, shards: Mapping[str, Callable[[], DataFrame]], options: Mapping
) -> DataFrame:
    """The table that ``shards`` make up, each built unless it is finished under the same ``options``.

    ``options`` hold everything that the rows depend on. If any differs, every shard is built again, and what was
    published before stays readable until the new build is published. A shard that fails raises, and leaves
    those before it finished: the next call goes on from there. Shards no longer named are
    left out of the new build. All shards must have the same columns. One log entry is collected per shard.
    """
    fingerprint, root = options_fingerprint(options), root.rstrip("/")
    done = finished_shards(spark, root, fingerprint)
    for name, build in shards.items():
        if name in done:
            continue
        path = f"{root}/data/{uuid.uuid4().hex}"
        rows = build()
        rows.write.parquet(path)
        schema = rows.schema.json()
        _append(spark, root, kind="shard", fingerprint=fingerprint, shard=name, path=path, at=time.time(), schema=schema)
        done[name] = (path, schema)
    if not shards:
        raise ValueError("a build has at least one shard")
    schemas = {done[name][1] for name in shards}
    if len(schemas) > 1:
        raise ValueError(f"shards differ in their columns: {sorted(schemas)}")
    paths = [done[name][0] for name in shards]
    published = last_published(spark, root)
    if published is None or published["fingerprint"] != fingerprint or published["shards"] != paths:
        _append(
            spark, root, kind="build", fingerprint=fingerprint, build=uuid.uuid4().hex, at=time.time(), shards=paths, schema=schemas.pop()
        )
    return read_published(spark, root)


def last_published(spark: SparkSession, root: str) -> dict | None:
    """The entry of the last published build."""
    found = read_log(spark, root).where("kind = 'build'").orderBy(F.desc("at"), F.desc("build")).limit(1).collect()
    return found[0].asDict() if found else None


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the last published build, whatever is being built beside it."""
    build = last_published(spark, root)
    if build is None:
        raise FileNotFoundError(f"nothing was published below {root}")
    return spark.read.schema(T.StructType.fromJson(json.loads(build["schema"]))).parquet(*build["shards"])
