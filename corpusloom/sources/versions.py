"""Tables whose state is a small manifest, replaced in one rename: upserts by hash bucket (K4, K5) and resumable appends (K2).

Data goes into a folder of its own first; what a reader sees changes only when
the next manifest stands whole under its name. A run lost before that leaves the
table as it was, with a folder that nothing names (``vacuum`` removes it); one
lost after it has lost nothing. Old manifests keep their folders readable until
they are vacuumed. One writer at a time is meant: a second one that began from
the same version finds the next manifest taken and fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from corpusloom.operators.relational import last_wins
from corpusloom.sources.sinks import delete


class Conflict(RuntimeError):
    """Another writer has made this version."""


@dataclass
class Manifests:
    """Numbered JSON files in a folder that any Hadoop file system holds."""

    spark: SparkSession
    path: str

    def _fs(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path
        return at(self.path).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), at

    def numbers(self) -> list[int]:
        fs, at = self._fs()
        if not fs.exists(at(self.path)):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(at(self.path))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def name(self, number: int) -> str:
        return f"{self.path}/{number:012d}.json"

    def get(self, number: int) -> dict:
        return json.loads(self.spark.read.text(self.name(number), wholetext=True).first()[0])

    def put(self, number: int, content: dict) -> None:
        fs, at = self._fs()
        fs.mkdirs(at(self.path))
        made = at(f"{self.path}/{uuid.uuid4().hex}.tmp")
        out = fs.create(made, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        if fs.exists(at(self.name(number))) or not fs.rename(made, at(self.name(number))):
            fs.delete(made, False)
            raise Conflict(f"version {number} of {self.path} is there already")


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


@dataclass
class BucketTable:
    """Rows unique by ``keys`` in ``buckets`` hash buckets; an upsert reads and rewrites the buckets of its keys only.

    Of source rows with equal keys the one of the greatest ``seq`` wins, then it
    replaces the table's row. Keys may be null; nulls are equal.
    """

    spark: SparkSession
    path: str
    keys: list[str]
    buckets: int = 64
    manifests: Manifests = field(init=False)

    def __post_init__(self) -> None:
        self.manifests = Manifests(self.spark, f"{self.path}/manifests")

    def version(self) -> int | None:
        return max(self.manifests.numbers(), default=None)

    def _state(self, version: int | None) -> dict | None:
        number = self.version() if version is None else version
        state = None if number is None else self.manifests.get(number)
        if state and (state["keys"], state["buckets"]) != (self.keys, self.buckets):
            raise ValueError(f"the table has keys {state['keys']} in {state['buckets']} buckets")
        return state

    def _rows(self, state: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        folders = [f"{self.path}/{f}" for b, f in state["folders"].items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        state = self._state(version)
        if state is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._rows(state)

    def upsert(self, source: DataFrame, seq: str = "seq") -> list[int]:
        """Take in ``source``; the buckets it rewrote."""
        number = self.version()
        state = self._state(number) or {"keys": self.keys, "buckets": self.buckets, "schema": source.schema.json(), "folders": {}}
        names = T.StructType.fromJson(json.loads(state["schema"])).names
        folder = f"data/{uuid.uuid4().hex}"
        staged = f"{self.path}/{folder}-new"
        # the winners are written apart: their buckets are known before any old row is read
        last_wins(source, self.keys, seq).select(*names).withColumn("bucket_", bucket_of(self.keys, self.buckets)).write.parquet(staged)
        new = self.spark.read.parquet(staged)
        touched = sorted(r["bucket_"] for r in new.select("bucket_").distinct().collect())  # ``buckets`` of them at most
        if not touched:
            delete(self.spark, staged)
            return []
        old = self._rows(state, touched).alias("o")
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
        kept = old.join(new.select(*self.keys).alias("n"), same, "left_anti").withColumn("bucket_", bucket_of(self.keys, self.buckets))
        merged = new.select(*names, "bucket_").unionByName(kept)
        merged.repartition("bucket_").write.partitionBy("bucket_").parquet(f"{self.path}/{folder}")
        delete(self.spark, staged)
        folders = state["folders"] | {str(b): f"{folder}/bucket_={b}" for b in touched}
        self.manifests.put(0 if number is None else number + 1, state | {"folders": folders})
        return touched

    def vacuum(self, keep: int = 1) -> None:
        """Remove all but the newest ``keep`` manifests and the folders that none of those names."""
        numbers = self.manifests.numbers()
        for number in numbers[:-keep]:
            delete(self.spark, self.manifests.name(number))
        used = {f for n in numbers[-keep:] for f in self.manifests.get(n)["folders"].values()}
        fs, at = self.manifests._fs()
        root = at(f"{self.path}/data")
        for top in fs.listStatus(root) if fs.exists(root) else []:
            inner = [f.getPath().getName() for f in fs.listStatus(top.getPath())]
            name = top.getPath().getName()
            dead = [x for x in inner if x.startswith("bucket_=") and f"data/{name}/{x}" not in used]
            if not any(f"data/{name}/{x}" in used for x in inner):
                fs.delete(top.getPath(), True)
            else:
                for x in dead:
                    delete(self.spark, f"{self.path}/data/{name}/{x}")


@dataclass
class AppendLog:
    """Rows appended in numbered batches, each key once: a batch's rows and its done keys become visible in the same rename.

    The done keys are the key columns of the committed rows, so nothing can stand
    in one of the two alone. A batch that is committed is never taken again, and
    rows whose key an earlier batch has are left out. Null keys are equal.
    """

    spark: SparkSession
    path: str
    key: str
    manifests: Manifests = field(init=False)

    def __post_init__(self) -> None:
        self.manifests = Manifests(self.spark, f"{self.path}/batches")

    def committed(self) -> list[int]:
        return self.manifests.numbers()

    def read(self) -> DataFrame | None:
        """The rows of all committed batches, with ``batch_id``; None before the first."""
        parts = self.spark.read.json(f"{self.path}/batches/*.json").filter("rows > 0").select("folder", "schema").collect() if self.committed() else []
        if not parts:
            return None
        schema = T.StructType.fromJson(json.loads(parts[0]["schema"]))
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{p['folder']}" for p in parts])

    def append(self, batch_id: int, rows: DataFrame, seq: str = "seq") -> int:
        """Commit what is new in ``rows``; how many rows that was, 0 where the batch is committed already."""
        if batch_id in self.committed():
            return 0
        new = last_wins(rows, [self.key], seq).withColumn("batch_id", F.lit(batch_id).cast("long"))
        done = self.read()
        if done is not None:
            new = new.join(done.select(F.col(self.key).alias("done_")), F.col(self.key).eqNullSafe(F.col("done_")), "left_anti")
        folder = f"data/{batch_id:012d}-{uuid.uuid4().hex}"
        new.write.parquet(f"{self.path}/{folder}")
        n = self.spark.read.parquet(f"{self.path}/{folder}").count()
        self.manifests.put(batch_id, {"folder": folder, "rows": n, "schema": new.schema.json()})
        return n
