"""Tables on plain Parquet: whole versions, partition-wise upsert, namespaces and views.

Partitioned tables may have several writers at once. Of a table of whole
versions one writer at a time is assumed.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindsight.operators.upsert import DuplicateKeys, require_unique, upsert, upsert_groups
from hindsight.session import delete, null_safe, staged
from hindsight.sources.commits import Commits, Contended, file_system

LAYERS = ("bronze", "silver", "gold")
#: Names the folder of one write of a partitioned table; no table may have such a column.
WRITE = "table_write"


def exists(spark: SparkSession, path: str) -> bool:
    files, location = file_system(spark, path)
    return files.exists(location)


@dataclass(frozen=True)
class VersionedTable:
    """A folder of whole versions ``v=<n>``.

    A version counts from the moment Spark's own commit marker is in it, so
    readers see the old table or the new one, never half of one. Writing the
    same version number again replaces it, which makes replays harmless.
    """

    spark: SparkSession
    path: str

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        files, location = file_system(self.spark, self.path)
        if not files.exists(location):
            return []
        names = [s.getPath().getName() for s in files.listStatus(location) if s.isDirectory()]
        found = sorted(int(n[2:]) for n in names if n.startswith("v="))
        return [v for v in found if exists(self.spark, f"{self.location(v)}/_SUCCESS")]

    def current(self) -> int | None:
        return max(self.versions(), default=None)

    def location(self, version: int) -> str:
        return f"{self.path}/v={version:010d}"

    def exists(self) -> bool:
        return self.current() is not None

    def read(self, version: int | None = None) -> DataFrame:
        version = self.current() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no committed version below {self.path}")
        return self.spark.read.parquet(self.location(version))

    def write(self, df: DataFrame, version: int | None = None) -> int:
        """Full rebuild: ``df`` becomes the next version, whatever its schema."""
        if version is None:
            version = (self.current() or 0) + 1
        df.write.mode("overwrite").parquet(self.location(version))
        return version

    def before(self, version: int) -> DataFrame | None:
        """Newest version below ``version``: what a replayed write must start from."""
        older = [v for v in self.versions() if v < version]
        return self.read(older[-1]) if older else None

    def upsert(self, df: DataFrame, keys: list[str], version: int | None = None, check: bool = True) -> int:
        """Create on the first run, else update matching keys and insert the others."""
        base = (self.read() if self.exists() else None) if version is None else self.before(version)
        with staged(df) as source:
            if base is not None:
                return self.write(upsert(base, source, keys, check), version)
            if check:
                require_unique(source, keys)
            return self.write(source, version)

    def upsert_groups(self, df: DataFrame, group: list[str]) -> int:
        """Replace every group ``df`` has rows of."""
        with staged(df) as source:
            return self.write(upsert_groups(self.read(), source, group) if self.exists() else source)

    def vacuum(self, keep: int = 1) -> None:
        """Delete all but the newest ``keep`` versions; nothing goes on its own."""
        for version in self.versions()[:-keep]:
            delete(self.spark, self.location(version))


@dataclass(frozen=True)
class PartitionedTable:
    """Partitions in slices, of which an upsert writes only those it touches, for tables too large to write anew.

    Every write goes to a folder of its own, ``table_write=<n>-<id>/<partition>=<value>``,
    a *slice* of the partition, and nothing is ever written over. A manifest names
    the slices that each partition is now read from, and the table's schema; the
    write counts from the moment the next manifest is in place. A crash before
    that leaves the table as it was.

    The rows of an upsert are written once, as slices beside those there are. Of
    the slices that hold one of its keys, and of partitions that have ``SLICES`` of
    them, the other rows are written anew.

    Writers don't wait for each other. One that finds its manifest's number taken
    looks at what came between: if the slices that it replaces are still there and
    the new ones have none of its keys, its own go on top of it, else it merges
    anew with what the table is now. So the outcome is that of some order of the
    writes.

    Beside each slice lies a filter of its keys, a Bloom filter as rows: a key
    marks four bits of one 64-bit word, chosen by its hash, and words are as many
    as a quarter of the keys. An upsert joins its keys with the words and opens
    only partitions whose words have all bits of one, about one in a hundred by
    chance, so none is ruled out for more than ``FILTERED`` keys. Partitions written
    under other keys are opened always.

    Folders that no manifest names go by ``vacuum``, never on their own.
    """

    spark: SparkSession
    path: str
    partition: str

    @property
    def commits(self) -> Commits:
        return Commits(self.spark, f"{self.path}/_manifests")

    def manifests(self) -> list[int]:
        return self.commits.numbers()

    def state(self, number: int | None = None) -> dict:
        """``entries``, ``schema`` and the partitions ``touched`` by the commit of a number, or the newest."""
        number = self.commits.newest() if number is None else number
        return self.commits.read(number) if number else {"entries": {}, "schema": None, "touched": []}

    def manifest(self, number: int | None = None) -> dict[str, dict]:
        """What is known of each partition, by its folder's name: the write it is in, its filter's words and keys; the same of ``more`` slices."""
        return self.state(number)["entries"]

    def _commit(self, state: dict, number: int) -> bool:
        return self.commits.put(number, state)

    def exists(self) -> bool:
        return bool(self.manifests())

    def schema(self) -> T.StructType | None:
        text = self.state()["schema"]
        return T.StructType.fromJson(json.loads(text)) if text else None

    def _load(self, entries: dict[str, dict], schema: T.StructType) -> DataFrame:
        folders = [f"{self.path}/{part['write']}/{name}" for name, part in _slices(entries)]
        rows = self.spark.read.option("basePath", self.path).schema(schema).parquet(*folders)
        return rows if WRITE in schema.names else rows.drop(WRITE)

    def read(self, like: DataFrame | None = None) -> DataFrame:
        """All rows; with ``like`` its column types win and its new columns are there, null."""
        state = self.state()
        return self._typed(state["entries"], state, like)

    def _typed(self, entries: dict[str, dict], state: dict, like: DataFrame | None) -> DataFrame:
        schema = _wider(state["schema"], None if like is None else like.schema, self.partition)
        if not entries:
            if like is None and not state["schema"]:
                raise FileNotFoundError(f"no rows below {self.path}")
            return self.spark.createDataFrame([], schema)
        return self._load(entries, schema)

    def at(self, number: int, names: Sequence[str] | set[str] | None = None) -> DataFrame:
        """Rows as of a commit, all or those of some partition folders; its columns are those of the newest."""
        state = self.state(number)
        entries = {n: e for n, e in state["entries"].items() if names is None or n in names}
        return self._typed(entries, self.state(), None)

    def holding(self, keys_of: DataFrame, keys: list[str]) -> list[str | None]:
        """Partitions that now hold one of the keys; of those that their filters let pass, key columns are read."""
        return sorted({self.value_of(name) for name, _ in self._holding(self.state()["entries"], keys_of, keys)}, key=lambda v: (v is None, v))

    def _holding(self, entries: dict[str, dict], keys_of: DataFrame, keys: list[str]) -> set[tuple[str, str]]:
        """Slices that hold one of the keys: their partitions' folders and writes."""
        entries = self.possibly_holding(entries, keys_of, keys)
        if not entries:
            return set()
        fields = [keys_of.schema[k] for k in keys if k != self.partition]
        places = [T.StructField(WRITE, T.StringType()), T.StructField(self.partition, T.StringType())]
        target = self._load(entries, T.StructType([*fields, *places]))
        wanted = keys_of.select(*keys).distinct()
        held = target.join(wanted, null_safe(target, wanted, keys), "left_semi")
        return {(self.folder(r[0]), f"{WRITE}={r[1]}") for r in held.select(target[self.partition], target[WRITE]).distinct().collect()}

    def possibly_holding(self, entries: dict[str, dict], keys_of: DataFrame, keys: list[str]) -> dict[str, dict]:
        """The entries, with those slices whose filters don't rule out all of the keys."""
        kind = _kinds(keys_of, keys)
        filtered = [(n, e) for n, e in _slices(entries) if e["keys"] == kind]
        if not filtered or keys_of.limit(FILTERED + 1).count() > FILTERED:
            return entries
        hashed = keys_of.select(key_hash(keys).alias("h")).distinct()
        classes = F.array(*[F.lit(w).cast("long") for w in sorted({e["words"] for _, e in filtered})])
        wanted = hashed.select(F.explode(classes).alias("words"), "h").select("words", _word("h", "words").alias("word"), _mask("h").alias("mask"))
        known = self.spark.createDataFrame([(n, e["write"]) for n, e in filtered], "part string, write string")
        writes = sorted({e["write"] for _, e in filtered})
        filters = self.spark.read.schema(FILTER).parquet(*[f"{self.path}/_keys/{w}" for w in writes])
        here = filters.join(known, ["part", "write"], "left_semi").join(wanted, ["words", "word"])
        places = here.where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select("part", "write").distinct()
        hits = {tuple(row) for row in places.collect()}
        return _entries([(n, e) for n, e in _slices(entries) if (n, e["write"]) in hits or e["keys"] != kind])

    def _write_filters(self, write: str, names: Sequence[str], schema: T.StructType, keys: list[str]) -> dict[str, dict]:
        """Filters of the partitions just written; their manifest entries."""
        columns = [f.name for f in schema if f.name != self.partition]
        entries = {n: {"write": write, "words": 0, "keys": "", "columns": columns} for n in names}
        if not names:
            return entries
        rows = self._load(entries, schema)
        kind = _kinds(rows, keys)
        hashed = rows.select(F.col(self.partition).alias("value"), key_hash(keys).alias("h"))
        sizes = {self.folder(r["value"]): r["n"] for r in hashed.groupBy("value").agg(F.count("*").alias("n")).collect()}
        for name, entry in entries.items():
            entry["words"], entry["keys"] = 1 << max(0, (sizes.get(name, 0) - 1).bit_length() - 2), kind
        known = self.spark.createDataFrame([(self.value_of(n), n, e["words"]) for n, e in entries.items()], "value_ string, part string, words long")
        marked = hashed.join(known, F.col("value").eqNullSafe(F.col("value_"))).select("part", "words", _word("h", "words").alias("word"), _mask("h").alias("mask"))
        words = marked.groupBy("part", "words", "word").agg(F.bit_or("mask").alias("bits")).withColumn("write", F.lit(write))
        words.select(*FILTER.names).write.mode("overwrite").parquet(f"{self.path}/_keys/{write}")
        return entries

    def folder(self, value: str | None) -> str:
        """Name of a partition's folder as Spark writes it."""
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return f"{self.partition}=" + ("__HIVE_DEFAULT_PARTITION__" if value is None else escape(value))

    def value_of(self, folder: str) -> str | None:
        """The partition value that a folder is named for."""
        name = folder.partition("=")[2]
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return None if name == "__HIVE_DEFAULT_PARTITION__" else unescape(name)

    def rows_in(self, partitions: Sequence[str | None], like: DataFrame | None = None) -> DataFrame:
        """Rows of some partitions; no other folder is read."""
        names, state = {self.folder(p) for p in partitions}, self.state()
        return self._typed({n: e for n, e in state["entries"].items() if n in names}, state, like)

    def upsert(
        self, df: DataFrame, keys: list[str], check: bool = True, held: Sequence[str | None] | None = None, at: int | None = None
    ) -> None:
        """Update matching keys, insert the others.

        ``held`` may name the partitions that hold the keys, if known. With
        ``at`` the rows were made from what the table was at that commit:
        where others have written meanwhile what this write touches,
        ``Contended`` is raised, for the caller to make them anew.
        """
        self._replace(df, None, keys, held, at, check=check)

    def replace_groups(
        self,
        df: DataFrame,
        groups: DataFrame,
        keys: list[str],
        held: Sequence[str | None] | None = None,
        at: int | None = None,
        note: dict | None = None,
    ) -> None:
        """All rows of ``groups`` give way to those ``df`` has of them, which may be none.

        ``note`` is kept with the commit, and with later ones until there is another.
        """
        self._replace(df, groups.select(*keys).distinct(), keys, held, at, note)

    def replace_all(self, df: DataFrame, keys: list[str], note: dict | None = None) -> None:
        """``df`` is the table from now on."""
        for _ in range(ATTEMPTS):
            number = self.commits.newest()
            write, made = self._write(df, number + 1, keys)
            entries = self.manifest(number).keys() | made.keys()
            state = {"entries": made, "schema": _wider(None, df.schema, self.partition).json(), "touched": sorted(entries), "note": note}
            if self._commit(state, number + 1):
                return
            self._forget(write)
        raise Contended(f"{self.path}: others wrote {ATTEMPTS} times meanwhile")

    def _write(self, rows: DataFrame, number: int, keys: list[str]) -> tuple[str, dict[str, dict]]:
        """Write partitions and their filters to a folder of this write's own."""
        write = f"{WRITE}={number:010d}-{uuid.uuid4().hex[:12]}"
        # one task per partition, or several where AQE finds one large
        rows.hint("rebalance", self.partition).write.partitionBy(self.partition).parquet(f"{self.path}/{write}")
        # What was written says which partitions there are now.
        files, location = file_system(self.spark, f"{self.path}/{write}")
        written = sorted(s.getPath().getName() for s in files.listStatus(location) if s.isDirectory())
        return write, self._write_filters(write, written, rows.schema, keys)

    def _forget(self, write: str) -> None:
        for folder in (f"{self.path}/{write}", f"{self.path}/_keys/{write}"):
            delete(self.spark, folder)

    def _replace(
        self, df: DataFrame, groups: DataFrame | None, keys: list[str], held, at: int | None, note: dict | None = None, check: bool = False
    ) -> None:
        """``df`` instead of the rows of ``groups``, which are its own keys if there are none."""
        # Written once, whatever others do meanwhile.
        own, mine = self._write(df, (self.commits.newest() if at is None else at) + 1, keys)
        schema = _wider(None, df.schema, self.partition)
        source = self._load(mine, schema) if mine else self.spark.createDataFrame([], schema)
        touched = source.select(*keys) if groups is None else groups
        if check:
            try:
                require_unique(source, keys)
            except DuplicateKeys:
                self._forget(own)
                raise
        for _ in range(ATTEMPTS if at is None else 1):
            number = self.commits.newest() if at is None else at
            state = self.state(number)
            there = _slices(state["entries"])
            # A row that moves to another partition leaves no copy behind.
            if held is None:
                gone = self._holding(state["entries"], touched, keys)
            else:
                # The new rows' own partitions too: a write that is replayed may have put the keys there.
                names = {self.folder(v) for v in held} | mine.keys()
                gone = {(n, e["write"]) for n, e in there if n in names}
            full = {n for n in mine if n in state["entries"] and len(_slices({n: state["entries"][n]})) >= SLICES}
            gone |= {(n, e["write"]) for n, e in there if n in full}
            again, kept = None, {}
            if gone:
                affected = self._typed(_entries([(n, e) for n, e in there if (n, e["write"]) in gone]), state, source)
                again, kept = self._write(affected.join(touched, null_safe(affected, touched, keys), "left_anti"), number + 1, keys)
            # Partitions without slices are empty now.
            if self._land(number, state, gone, [*_slices(mine), *_slices(kept)], schema, touched, keys, note, at is not None):
                return
            held = None
            if again:
                self._forget(again)
        self._forget(own)
        raise Contended(f"{self.path}: others wrote what this write touches")

    def _land(
        self, number: int, state: dict, gone: set[tuple[str, str]], made: list[tuple[str, dict]], schema, touched: DataFrame, keys: list[str], note: dict | None, alone: bool
    ) -> bool:
        """Commit on top of ``state`` or of what came since, if that leaves this write right; whether it did.

        With ``alone`` nothing else may have been written to its partitions.
        """
        places = {n for n, _ in [*gone, *made]}
        while True:
            entries = _entries([*[(n, e) for n, e in _slices(state["entries"]) if (n, e["write"]) not in gone], *made])
            wider = _wider(state["schema"], schema, self.partition).json()
            after = {"entries": entries, "schema": wider, "touched": sorted(places), "note": note or state.get("note")}
            if self._commit(after, number + 1):
                return True
            newest = self.commits.newest()
            if not set(range(number + 1, newest + 1)) <= set(self.manifests()):
                return False  # vacuum took what came between
            others = set().union(*(self.state(n)["touched"] for n in range(number + 1, newest + 1)))
            before, state, number = {(n, e["write"]) for n, e in _slices(state["entries"])}, self.state(newest), newest
            now = _slices(state["entries"])
            if (alone and others & places) or not gone <= {(n, e["write"]) for n, e in now}:
                return False
            if self._holding(_entries([(n, e) for n, e in now if (n, e["write"]) not in before]), touched, keys):
                return False

    def vacuum(self, keep: int = 1, grace_hours: float = 24.0) -> None:
        """Delete what only manifests older than the newest ``keep`` name, and those manifests.

        Folders that no manifest ever named may be of a write under way: they go
        once they are older than ``grace_hours``.
        """
        numbers = self.manifests()
        folders = lambda some: {f"{e['write']}/{name}" for n in some for name, e in _slices(self.manifest(n))}
        named, once = folders(numbers[-keep:]), folders(numbers[:-keep])
        files, location = file_system(self.spark, self.path)
        oldest = (time.time() - 3600 * grace_hours) * 1000
        for n in numbers[:-keep]:
            self.commits.drop(n)
        for write in [s for s in files.listStatus(location) if s.getPath().getName().startswith(f"{WRITE}=")]:
            name = write.getPath().getName()
            parts = [s.getPath().getName() for s in files.listStatus(write.getPath()) if s.isDirectory()]
            used = [p for p in parts if f"{name}/{p}" in named]
            for p in [p for p in parts if p not in used]:
                if f"{name}/{p}" in once or write.getModificationTime() < oldest:
                    delete(self.spark, f"{self.path}/{name}/{p}")
                else:
                    used.append(p)
            if not used and (parts or write.getModificationTime() < oldest):
                delete(self.spark, f"{self.path}/{name}")
                delete(self.spark, f"{self.path}/_keys/{name}")


#: What lies in a key filter: of which partition and write, of how many words which one, and its bits.
FILTER = T.StructType().add("part", "string").add("write", "string").add("words", "long").add("word", "long").add("bits", "long")
#: A write that others get ahead of is merged anew so often.
ATTEMPTS = 20
#: A partition that has so many slices is written as a whole by the next write to it.
SLICES = 8
#: More keys than this pass some word of any filter by chance.
FILTERED = 5000


def _slices(entries: dict[str, dict]) -> list[tuple[str, dict]]:
    """Partitions' folders with one slice each."""
    return [(n, {k: v for k, v in part.items() if k != "more"}) for n, e in sorted(entries.items()) for part in (e, *e.get("more", []))]


def _entries(slices: Sequence[tuple[str, dict]]) -> dict[str, dict]:
    """The same by folder: the first slice, and ``more`` of them where there are."""
    entries: dict[str, dict] = {}
    for name, part in slices:
        if name in entries:
            entries[name].setdefault("more", []).append(part)
        else:
            entries[name] = dict(part)
    return entries


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _kinds(df: DataFrame, keys: Sequence[str]) -> str:
    """Names and types of the keys: hashes of other types differ."""
    return ",".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)


def _word(h: str, words: str) -> Column:
    """``words`` is a power of two: the word is the low bits of the hash."""
    return F.col(h).bitwiseAND(F.col(words) - 1)


def _mask(h: str) -> Column:
    """Four of 64 bits, chosen by the hash's high bits."""
    bits = [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(`{h}`, {at}) & 63 as int))") for at in (40, 46, 52, 58)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def _wider(have: str | None, other: T.StructType | None, partition: str) -> T.StructType:
    """Columns of both, the types of ``other`` where both have one; the partition is text and comes last."""
    kinds = {} if have is None else {f.name: f.dataType for f in T.StructType.fromJson(json.loads(have))}
    kinds |= {} if other is None else {f.name: f.dataType for f in other}
    kinds.pop(partition, None)
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()] + [T.StructField(partition, T.StringType())])


def create_namespaces(spark: SparkSession, prefix: str = "") -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{prefix}{layer}`")


def publish(spark: SparkSession, name: str, table: VersionedTable | PartitionedTable) -> None:
    """Point the catalog name at what the table now is; one catalog write, so readers switch at once."""
    if isinstance(table, VersionedTable):
        query = f"SELECT * FROM parquet.`{table.location(table.current())}`"
    else:
        state = table.state()
        fields = [f for f in table.schema() if f.name != table.partition]
        parts = []
        for name_, entry in _slices(state["entries"]):
            # the writes' own schema says which columns a partition lacks
            have = set(entry.get("columns", [f.name for f in fields]))
            listed = ", ".join(f"`{f.name}`" if f.name in have else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
            value = table.value_of(name_)
            literal = "CAST(NULL AS STRING)" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
            parts.append(f"SELECT {listed}, {literal} AS `{table.partition}` FROM parquet.`{table.path}/{entry['write']}/{name_}`")
        query = " UNION ALL ".join(parts)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def create_once(df: DataFrame, name: str) -> bool:
    """Save as a catalog table if there is none of the name yet; whether it was created."""
    if df.sparkSession.catalog.tableExists(name):
        return False
    df.write.saveAsTable(name)
    return True


def create_view(spark: SparkSession, name: str, query: str, temporary: bool = False) -> None:
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {name} AS {query}")


def merge_statement(table: str, source: str, keys: list[str]) -> str:
    """The same upsert for a catalog whose tables take MERGE."""
    on = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)
    return (
        f"MERGE INTO {table} AS t USING {source} AS s ON {on} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
