"""A run: ordered stages with written results, a lease, and gates between them."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATES = ("pending", "running", "complete", "failed")


def merged(defaults: dict, own: dict) -> dict:
    """Defaults overridden by the own settings, level by level; unknown settings are an error."""
    unknown = set(own) - set(defaults)
    if unknown:
        raise KeyError(f"unknown settings: {sorted(unknown)}")
    return {k: merged(v, own[k]) if isinstance(v, dict) and isinstance(own.get(k), dict) else own.get(k, v) for k, v in defaults.items()}


class Store:
    """Small JSON documents in a folder of any store that Spark knows."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def read(self, name: str) -> dict | None:
        where = self.path(f"{self.folder}/{name}.json")
        if not self.fs.exists(where):
            return None
        stream = self.fs.open(where)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write(self, name: str, value: dict, create_only: bool = False) -> bool:
        """Whether it was written; with ``create_only`` an existing document stays."""
        where = self.path(f"{self.folder}/{name}.json")
        if create_only:
            try:
                out = self.fs.create(where, False)
            except Exception:
                return False
        else:
            out = self.fs.create(where, True)
        out.write(json.dumps(value, sort_keys=True).encode())
        out.close()
        return True

    def names(self, prefix: str) -> list[str]:
        """Documents whose name begins so."""
        folder = self.path(self.folder)
        found = [x.getPath().getName() for x in self.fs.listStatus(folder)] if self.fs.exists(folder) else []
        return [n.removesuffix(".json") for n in found if n.startswith(prefix) and n.endswith(".json")]

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(f"{self.folder}/{name}.json"), False)


class Lease:
    """One holder at a time, until it lets go or its time is over.

    Each holding is a file of its own, numbered in turn and created only where none is:
    of two that take over an expired lease one fails.  Its holder alone rewrites it, to
    renew it or to let go.
    """

    def __init__(self, store: Store, name: str, seconds: float, now: Callable[[], float] = time.time):
        self.store, self.name, self.seconds, self.now, self.token, self.number = store, name, seconds, now, uuid.uuid4().hex, 0

    def _held(self) -> tuple[int, dict | None]:
        """The last number, and who holds it."""
        number = max([int(n.rpartition("-")[2]) for n in self.store.names(f"{self.name}-")] or [0])
        try:
            return number, self.store.read(f"{self.name}-{number:08d}") if number else None
        except ValueError:  # it is being written
            return number, {"until": float("inf")}

    def _own(self) -> str:
        return f"{self.name}-{self.number:08d}"

    def __enter__(self):
        number, held = self._held()
        if held and held["until"] > self.now():
            raise RuntimeError(f"{self.name} is held by another run")
        self.number = number + 1
        if not self.store.write(self._own(), {"token": self.token, "until": self.now() + self.seconds}, create_only=True):
            raise RuntimeError(f"{self.name} is held by another run")
        return self

    def renew(self) -> None:
        """Hold on for as long again; an error if another has taken over meanwhile."""
        number, _ = self._held()
        if number != self.number:
            raise RuntimeError(f"{self.name} was taken over")
        self.store.write(self._own(), {"token": self.token, "until": self.now() + self.seconds})

    def __exit__(self, *_):
        self.store.write(self._own(), {"token": self.token, "until": 0})


class Keeper:
    """Renews a lease from a thread of its own for as long as a stage takes."""

    def __init__(self, lease: Lease):
        self.lease, self.over = lease, threading.Event()
        self.thread = threading.Thread(target=self._run, daemon=True)

    def _run(self) -> None:
        while not self.over.wait(self.lease.seconds / 3):
            self.lease.renew()

    def __enter__(self):
        self.thread.start()
        return self

    def __exit__(self, *_):
        self.over.set()
        self.thread.join()


@dataclass
class Run:
    """Stages in order; each gets the session and its predecessors' tables, and its result is a table.

    A stage that is complete is not run again; one whose gate refuses fails the run.
    """

    spark: SparkSession
    folder: str
    stages: list[tuple[str, Callable[[SparkSession, dict[str, DataFrame]], DataFrame]]]
    gates: dict[str, Callable[[DataFrame], bool]] = field(default_factory=dict)
    lease_seconds: float = 900

    def plan(self) -> list[tuple[str, str]]:
        state = Store(self.spark, self.folder).read("run") or {}
        return [(name, state.get(name, {}).get("state", "pending")) for name, _ in self.stages]

    def execute(self) -> DataFrame | None:
        store = Store(self.spark, self.folder)
        done: dict[str, DataFrame] = {}
        with Lease(store, "lock", self.lease_seconds) as lease, Keeper(lease):
            state = store.read("run") or {}
            for name, action in self.stages:
                own = state.setdefault(name, {"state": "pending", "attempts": 0})
                path = f"{self.folder}/{name}"
                if own["state"] != "complete":
                    own |= {"state": "running", "attempts": own["attempts"] + 1}
                    store.write("run", state)
                    try:
                        action(self.spark, done).write.mode("overwrite").parquet(path)
                        result = self.spark.read.parquet(path)
                        if name in self.gates and not self.gates[name](result):
                            raise ValueError(f"the gate of {name} refuses its result")
                    except Exception as e:
                        own |= {"state": "failed", "error": str(e)[:500]}
                        store.write("run", state)
                        raise
                    own |= {"state": "complete", "rows": result.count()}
                    store.write("run", state)
                done[name] = self.spark.read.parquet(path)
        return done.get(self.stages[-1][0]) if self.stages else None


def frozen(spark: SparkSession, path: str, rows: int) -> DataFrame:
    """A table that another run has left, if it has as many rows as was proved of it."""
    found = spark.read.parquet(path)
    if found.count() != rows:
        raise ValueError(f"{path} does not have {rows} rows")
    return found


def by_keys(rows: DataFrame, key: str, size: int, store: Store, name: str, action: Callable[[DataFrame], None]) -> int:
    """``action`` on batches of ``size`` rows in order of a key that no two rows share; how many batches were left to do.

    The last key of a batch is stored after it, so what is done again after a crash is one batch.
    """
    done = 0
    while True:
        last = (store.read(name) or {}).get("last")
        rest = rows if last is None else rows.where(F.col(key) > F.lit(last))
        batch = rest.orderBy(key).limit(size)
        end = batch.agg(F.max(key)).first()[0]
        if end is None:
            return done
        action(rest.where(F.col(key) <= F.lit(end)))
        store.write(name, {"last": end})
        done += 1


def replayed(edges: DataFrame, stages: list[str]) -> DataFrame:
    """Edges of the partitions that are complete: what a graph is built of again after a crash."""
    return edges.where(F.col("stage").isin(*stages)).select("a", "b").distinct()
