"""Gold at the cost of what is new: changes of silver found by manifest, only their stretches redone.

The state of gold names the commit of games that it was made from. Partitions
whose manifest entry has changed since are compared, old rows with new ones, by
one aggregation. A changed row can alter rows of its person up to the longest
frame after it, and the ``DEPTH`` rows that follow. These *targets* are
computed anew and replaced.

What they look back on are whole months and, of months that aren't read, the
first and last ``DEPTH`` rows of each person: the *edges*, a small table kept
beside games. In a timeline of read months and edges of the others, each row
of a read month has the same rows before it as in the whole timeline.

If the settings differ, or the commit is gone, gold is built anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindsight.config import Settings
from hindsight.plans.gold import CONTEXT_COLUMNS, feature_table
from hindsight.schemas import GAME_KEY
from hindsight.session import null_safe, staged
from hindsight.sources.tables import PartitionedTable

MONTH = "activity_month"
#: Rows before it that a row of gold looks at, however long ago.
DEPTH = 2
GOLD_KEY = ["game_uuid", "account_id"]
PERSON_MONTH = ["person_id", MONTH]
EDGE_COLUMNS = ["person_id", *GAME_KEY, "start_ts", "end_ts", "result"]
ORDER = ["activity_sec", *GAME_KEY]


def changed_partitions(table: PartitionedTable, since: int, now: int) -> set[str]:
    old, new = table.manifest(since), table.manifest(now)
    return {name for name in old.keys() | new.keys() if old.get(name) != new.get(name)}


def changes(table: PartitionedTable, since: int, now: int) -> DataFrame:
    """(person_id, game_uuid, account, activity_sec, month) of rows that came, went or differ in what gold reads; twice if they moved."""
    names = changed_partitions(table, since, now)
    signed = []
    for number, sign in ((since, -1), (now, 1)):
        rows = table.at(number, names)
        told = [F.unix_timestamp(F.coalesce("start_ts", "end_ts")).alias("activity_sec"), F.xxhash64(*CONTEXT_COLUMNS, "end_ts").alias("hash")]
        signed.append(rows.select("person_id", *GAME_KEY, MONTH, *told, F.lit(sign).alias("sign")))
    columns = ["person_id", *GAME_KEY, "activity_sec", MONTH]
    return signed[0].unionByName(signed[1]).groupBy(*columns, "hash").agg(F.sum("sign").alias("sign")).where("sign != 0").select(*columns).distinct()


def edges_of(games: DataFrame) -> DataFrame:
    """The first and last rows of each person and month; rows without a time are nobody's context."""
    rows = games.select(*EDGE_COLUMNS, MONTH, F.unix_timestamp(F.coalesce("start_ts", "end_ts")).alias("activity_sec")).where("activity_sec IS NOT NULL")

    def ends(order: list[Column], name: str) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(*PERSON_MONTH).orderBy(*order))
        return rows.withColumn(name, nth).where(F.col(name) <= DEPTH)

    # one rank limit each, ahead of its exchange: few rows of a person's month leave a task
    first = ends([F.asc(c) for c in ORDER], "nth").withColumn("is_head", F.lit(True)).drop("nth")
    last = ends([F.desc(c) for c in ORDER], "nth").withColumn("is_head", F.lit(False)).drop("nth")
    both = first.unionByName(last).groupBy(*rows.columns)
    return both.agg(F.max("is_head").alias("is_head"), F.max(~F.col("is_head")).alias("is_tail"))


def months_between(first: Column, last: Column) -> Column:
    """Names of all months from one second to another."""
    begin, end = (F.trunc(F.timestamp_seconds(s).cast("date"), "MM") for s in (first, last))
    return F.transform(F.sequence(begin, end, F.expr("interval 1 month")), lambda d: F.date_format(d, "yyyy-MM"))


def stretches(changed: DataFrame, settings: Settings) -> DataFrame:
    """(person_id, changed_month, lo, hi): seconds between which rows may differ, one stretch a changed month."""
    longest = max(settings.frames.values())
    dated = changed.where("activity_sec IS NOT NULL").groupBy("person_id", F.col(MONTH).alias("changed_month"))
    return dated.agg(F.min("activity_sec").alias("lo"), (F.max("activity_sec") + longest).alias("hi"))


def _named(df: DataFrame, column: Column) -> list[str]:
    return [row[0] for row in df.select(F.explode(column).alias("m")).distinct().collect()]


def refresh_gold(games: PartitionedTable, edges: PartitionedTable, gold: PartitionedTable, settings: Settings = Settings()) -> bool:
    """Bring edges and gold up to the newest commit of games; whether it took less than all rows."""
    now, note = games.commits.newest(), gold.state().get("note") or {}
    since = note.get("games")
    if since == now and note.get("settings") == repr(settings):
        return True
    if since not in games.manifests() or note.get("settings") != repr(settings):
        _rebuild(games, edges, gold, now, settings)
        return False
    with staged(changes(games, since, now), "changes") as changed:
        _propagate(games, edges, gold, changed, now, settings)
    return True


def _note(now: int, settings: Settings) -> dict:
    return {"games": now, "settings": repr(settings)}


def _rebuild(games: PartitionedTable, edges: PartitionedTable, gold: PartitionedTable, now: int, settings: Settings) -> None:
    rows = games.at(now)
    edges.replace_all(edges_of(rows), PERSON_MONTH)
    table = feature_table(rows, settings)
    months = rows.select(F.col("game_uuid").alias("g"), F.col("account").alias("a"), MONTH)
    gold.replace_all(
        table.join(months, table["game_uuid"].eqNullSafe(months["g"]) & table["account_id"].eqNullSafe(months["a"])).drop("g", "a"),
        GOLD_KEY, note=_note(now, settings),
    )


def _propagate(games, edges, gold, changed: DataFrame, now: int, settings: Settings) -> None:
    persons = changed.select("person_id").distinct()
    touched = [row[0] for row in changed.select(MONTH).distinct().collect()]
    here = games.at(now, {games.folder(m) for m in touched})
    pairs = changed.select(*PERSON_MONTH).distinct()
    edges.replace_groups(edges_of(here.join(pairs, null_safe(here, pairs, PERSON_MONTH), "left_semi")), pairs, PERSON_MONTH, held=touched)

    longest = max(settings.frames.values())
    with staged(stretches(changed, settings), "stretches") as redone:
        stored = edges.read()
        known = stored.join(persons, null_safe(stored, persons, ["person_id"]), "left_semi")
        with staged(known, "edges") as known:
            follow = _following(known.where("is_head"), redone)
            months = set(touched) | set(_named(redone, months_between(F.col("lo") - longest, F.col("hi"))))
            months |= set(_named(follow, months_between(F.col("activity_sec") - longest, F.col("activity_sec"))))
            read = games.at(now, {games.folder(m) for m in months})
            mine = read.join(persons, null_safe(read, persons, ["person_id"]), "left_semi")
            others = known.where(~F.coalesce(F.col(MONTH).isin([m for m in months if m]), F.lit(False)))
            context = mine.unionByName(others.select(*EDGE_COLUMNS, MONTH), allowMissingColumns=True)
            with staged(_targets(mine, redone, follow, changed), "targets") as targets:
                table = feature_table(context, settings)
                wanted = targets.toDF("g", "a", MONTH)
                rows = table.join(wanted, table["game_uuid"].eqNullSafe(wanted["g"]) & table["account_id"].eqNullSafe(wanted["a"])).drop("g", "a")
                gone = targets.select(*GAME_KEY).unionByName(changed.select(*GAME_KEY)).distinct().toDF(*GOLD_KEY)
                gold.replace_groups(rows, gone, GOLD_KEY, note=_note(now, settings))


def _following(heads: DataFrame, redone: DataFrame) -> DataFrame:
    """Of each stretch the first rows of later months that may be the next ones after it."""
    later = heads.withColumnRenamed("person_id", "person_")
    joined = later.join(redone, later["person_"].eqNullSafe(redone["person_id"]) & (later["activity_sec"] > redone["hi"]))
    nth = F.row_number().over(Window.partitionBy("person_id", "changed_month").orderBy(*ORDER))
    return joined.withColumn("nth", nth).where(F.col("nth") <= DEPTH).select(*PERSON_MONTH, "changed_month", *ORDER)


def _targets(mine: DataFrame, redone: DataFrame, follow: DataFrame, changed: DataFrame) -> DataFrame:
    """(game_uuid, account, month) of rows to compute anew."""
    placed = mine.select("person_id", *GAME_KEY, MONTH, F.unix_timestamp(F.coalesce("start_ts", "end_ts")).alias("activity_sec"))
    wide = redone.select(F.col("person_id").alias("person_"), "changed_month", "lo", "hi", F.explode(months_between(F.col("lo"), F.col("hi"))).alias("month_"))
    near = placed.join(wide, placed["person_id"].eqNullSafe(wide["person_"]) & (placed[MONTH] == wide["month_"]) & (placed["activity_sec"] >= wide["lo"]))
    within = near.where("activity_sec <= hi").select(*GAME_KEY, MONTH)
    beyond = near.where("activity_sec > hi").select(*PERSON_MONTH, "changed_month", *ORDER)
    # The next rows are the first of those left in the last month of a stretch and of those that begin later months.
    nth = F.row_number().over(Window.partitionBy("person_id", "changed_month").orderBy(*ORDER))
    following = beyond.unionByName(follow).distinct().withColumn("nth", nth).where(F.col("nth") <= DEPTH).select(*GAME_KEY, MONTH)
    undated = changed.where("activity_sec IS NULL").select(*GAME_KEY, MONTH)
    return within.unionByName(following).unionByName(undated).distinct()
