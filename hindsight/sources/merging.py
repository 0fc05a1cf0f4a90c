"""A table that is merged when it is read: an upsert writes its rows and nothing else.

For streams, whose batches are small beside the table. A commit names the
*base*, in which each key is once, and the *deltas* since. Readers keep base
rows whose key no delta has and settle the others, newest row a key. Which row
is newest is a matter of the rows alone (``newest_by``, then all columns), so
deltas may come in any order, from any writer, and twice.

``compact`` writes anew what has become too much to settle at each read:
``MERGED`` deltas become one, and once deltas hold a share ``SHARE`` of the
base's bytes both become the base. So a row is written about ``1 / SHARE`` times
for each time that the table doubles, however small the batches are.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hindsight.operators.latest import latest_per_key
from hindsight.session import delete, null_safe
from hindsight.sources.commits import Commits, Contended, file_system

#: So many deltas are merged into one.
MERGED = 8
#: Deltas of this share of the base's bytes go into the base.
SHARE = 0.5
ATTEMPTS = 50


@dataclass(frozen=True)
class MergeTable:
    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    newest_by: tuple[str, ...]

    @property
    def commits(self) -> Commits:
        return Commits(self.spark, f"{self.path}/_commits")

    def state(self, number: int | None = None) -> dict:
        """``base`` and ``deltas``, each a list of (folder, bytes); ``schema``; the last ``batches`` by stream."""
        number = self.commits.newest() if number is None else number
        return self.commits.read(number) if number else {"base": [], "deltas": [], "schema": None, "batches": {}}

    def exists(self) -> bool:
        return bool(self.commits.newest())

    def _rows(self, folders: list, schema: T.StructType) -> DataFrame:
        paths = [f"{self.path}/{name}" for name, _ in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _newest(self, rows: DataFrame) -> DataFrame:
        order = [c for c in rows.columns if c not in self.keys and c not in self.newest_by]
        return latest_per_key(rows, list(self.keys), [*self.newest_by, *order])

    def _settled(self, state: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        base, late = self._rows(state["base"], schema), self._rows(state["deltas"], schema)
        if not state["deltas"]:
            return base
        keys = list(self.keys)
        named = late.select(*keys).distinct()
        same = null_safe(base, named, keys)
        # Of the base only rows that a delta renews are settled; the others are read as they are.
        return base.join(named, same, "left_anti").unionByName(self._newest(late.unionByName(base.join(named, same, "left_semi"))))

    def read(self, number: int | None = None) -> DataFrame:
        """One row a key: the table as of a commit, or of the newest."""
        state = self.state(number)
        if state["schema"] is None:
            raise FileNotFoundError(f"no commit below {self.path}")
        return self._settled(state)

    def append(self, df: DataFrame, batch: tuple[str, int] | None = None) -> bool:
        """Add a delta of ``df``, its newest row a key; columns that either side lacks are null there.

        ``batch`` is a stream's name and the number of its batch: one that the
        table has already is left out, and False returned.
        """
        if batch and self._has(self.state(), batch):
            return False
        entry = self._write(self._newest(df))

        def change(state: dict) -> dict | None:
            if batch and self._has(state, batch):
                return None
            batches = state["batches"] | ({batch[0]: batch[1]} if batch else {})
            return state | {"deltas": [*state["deltas"], entry], "schema": _union(state["schema"], df.schema), "batches": batches}

        done = self._change(change)
        if not done:
            delete(self.spark, f"{self.path}/{entry[0]}")
        return done

    @staticmethod
    def _has(state: dict, batch: tuple[str, int]) -> bool:
        return state["batches"].get(batch[0], -1) >= batch[1]

    def _write(self, rows: DataFrame) -> list:
        name = f"rows-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}")
        files, location = file_system(self.spark, f"{self.path}/{name}")
        return [name, files.getContentSummary(location).getLength()]

    def _change(self, change) -> bool:
        """Commit ``change`` of the newest state, tried anew if others were faster; False where it gives none."""
        for _ in range(ATTEMPTS):
            number = self.commits.newest()
            state = change(self.state(number))
            if state is None:
                return False
            if self.commits.put(number + 1, state):
                return True
        raise Contended(f"{self.path}: others committed {ATTEMPTS} times meanwhile")

    def compact(self, whole: bool = False) -> bool:
        """Merge deltas, or all into a new base, if it is time or ``whole``; whether anything was written.

        Deltas that others add meanwhile stay; if others compact the same, theirs stands.
        """
        state = self.state()
        deltas, base = state["deltas"], state["base"]
        late, old = (sum(size for _, size in part) for part in (deltas, base))
        into_base = whole or late >= SHARE * old
        if not deltas or not (into_base or len(deltas) >= MERGED):
            return False
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        entry = self._write(self._settled(state) if into_base else self._newest(self._rows(deltas, schema)))

        def change(now: dict) -> dict | None:
            if now["base"] != base or any(d not in now["deltas"] for d in deltas):
                return None
            rest = [d for d in now["deltas"] if d not in deltas]
            return now | ({"base": [entry], "deltas": rest} if into_base else {"deltas": [entry, *rest]})

        done = self._change(change)
        if not done:
            delete(self.spark, f"{self.path}/{entry[0]}")
        return done

    def vacuum(self, keep: int = 1, grace_hours: float = 24.0) -> None:
        """Delete folders that only commits older than the newest ``keep`` name, and those commits.

        Folders that no commit ever named may be of a writer at work: they go after ``grace_hours``.
        """
        numbers = self.commits.numbers()
        folders = lambda some: {name for n in some for part in ("base", "deltas") for name, _ in self.state(n)[part]}
        named, once = folders(numbers[-keep:]), folders(numbers[:-keep])
        files, location = file_system(self.spark, self.path)
        oldest = (time.time() - 3600 * grace_hours) * 1000
        for n in numbers[:-keep]:
            self.commits.drop(n)
        for status in files.listStatus(location):
            name = status.getPath().getName()
            if name.startswith("rows-") and name not in named and (name in once or status.getModificationTime() < oldest):
                delete(self.spark, f"{self.path}/{name}")


def _union(have: str | None, other: T.StructType) -> str:
    """Columns of both; the newer types stand."""
    kinds = {} if have is None else {f.name: f.dataType for f in T.StructType.fromJson(json.loads(have))}
    kinds |= {f.name: f.dataType for f in other}
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()]).json()
