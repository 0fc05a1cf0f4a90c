"""One run over all layers: ingest, silver, gold, then the checks that may fail it."""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindsight.config import Settings
from hindsight.operators.checks import enforce
from hindsight.operators.latest import SNAPSHOT_ORDER, latest_per_key
from hindsight.plans.checks import layer_report
from hindsight.plans.gold import dashboard_games
from hindsight.plans.incremental import MONTH, refresh_gold
from hindsight.plans.silver import build_games, build_moves
from hindsight.schemas import BRONZE, GAME_KEY
from hindsight.session import configure, null_safe, staged
from hindsight.sources.commits import Contended
from hindsight.sources.tables import ATTEMPTS, PartitionedTable, VersionedTable, create_namespaces, create_view, publish
from hindsight.streaming.ingest import document_stream, ingest_stream, payload_stream


@dataclass(frozen=True)
class Layout:
    """Where everything is, below one root on shared storage."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def bronze(self) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(self.path("bronze"))

    @property
    def games(self) -> PartitionedTable:
        return PartitionedTable(self.spark, self.path("games"), MONTH)

    @property
    def moves(self) -> PartitionedTable:
        return PartitionedTable(self.spark, self.path("moves"), MONTH)

    @property
    def edges(self) -> PartitionedTable:
        return PartitionedTable(self.spark, self.path("game_edges"), MONTH)

    @property
    def gold(self) -> PartitionedTable:
        return PartitionedTable(self.spark, self.path("game_features"), MONTH)

    def features(self) -> DataFrame:
        """Gold as models want it, without the month."""
        return self.gold.read().drop(MONTH)


def with_month(games: DataFrame) -> DataFrame:
    return games.withColumn(MONTH, F.date_format(F.coalesce("start_ts", "end_ts"), "yyyy-MM"))


def moves_by_month(games: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Moves beside their game's month, so that both tables rewrite the same partitions."""
    return build_moves(games, settings, keep=[MONTH])


def apply_snapshots(
    bronze: DataFrame, layout: Layout, accounts: DataFrame, friends: DataFrame, settings: Settings = Settings()
) -> None:
    """Bring games and moves up to date with some new snapshots.

    Only months that the snapshots or their games touch are written. A stored
    game newer than its new snapshot stays. Moves are replaced game by game,
    so that a game read anew with fewer moves keeps no old ones. Applying the
    same snapshots twice changes nothing. Where another run writes the same
    months meanwhile, what it wrote counts as stored and the rest is done anew.
    """
    incoming = with_month(build_games(bronze, accounts, friends, settings))
    with staged(incoming, "games") as fresh:
        for attempt in range(ATTEMPTS):
            try:
                return _apply(fresh, layout, settings)
            except Contended:
                if attempt == ATTEMPTS - 1:
                    raise


def _apply(fresh: DataFrame, layout: Layout, settings: Settings) -> None:
    at_games, at_moves = layout.games.commits.newest(), layout.moves.commits.newest()
    # Where these games are now. Moves lie in the same months, so that the
    # far larger table of moves is not searched for them.
    held = layout.games.holding(fresh, GAME_KEY)
    newest = fresh
    if held:
        keys = fresh.select(*GAME_KEY)
        stored = layout.games.rows_in(held, like=fresh)
        stored = stored.join(keys, null_safe(stored, keys, GAME_KEY), "left_semi")
        newest = latest_per_key(fresh.unionByName(stored), GAME_KEY, list(SNAPSHOT_ORDER))
    with staged(newest, "newest") as settled:
        # Moves first: until games are written they still name the old months, so
        # a run that died in between finds and replaces the same moves again.
        layout.moves.replace_groups(moves_by_month(settled, settings), settled, GAME_KEY, held=held, at=at_moves)
        layout.games.upsert(settled, GAME_KEY, check=False, held=held, at=at_games)


def refresh_silver(layout: Layout, accounts: DataFrame, friends: DataFrame, settings: Settings = Settings()) -> None:
    """Apply whatever bronze has received since the last time; the checkpoint knows.

    All of it in one batch, a backfill too: small batches would write the same
    months over and over.
    """
    query = (
        layout.spark.readStream.schema(BRONZE)
        .parquet(layout.path("bronze"))
        .writeStream.foreachBatch(lambda batch, _: apply_snapshots(batch, layout, accounts, friends, settings))
        .option("checkpointLocation", layout.path("_checkpoints/silver"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def refresh(
    landing: str,
    layout: Layout,
    accounts: DataFrame,
    friends: DataFrame,
    settings: Settings = Settings(),
    landed_as: str = "documents",
    catalog: str | None = None,
) -> list[tuple[str, bool, str]]:
    """Bronze, silver, gold, checks, in this order; raises after the full report if a check fails.

    Bronze and silver take in only what is new, and gold is redone where that
    changes it. Every layer is written and read back before the next one uses it, so a lost
    executor costs tasks, not the run. With ``catalog``, a prefix of schema
    names that may be empty, the layers are then there by name.
    """
    spark = configure(layout.spark)
    source = {"documents": document_stream, "rows": payload_stream}[landed_as]
    ingest_stream(source(spark, landing), layout.path("bronze"), layout.path("_checkpoints/bronze"))
    refresh_silver(layout, accounts, friends, settings)
    games, moves = layout.games.read(), layout.moves.read()
    refresh_gold(layout.games, layout.edges, layout.gold, settings)
    if catalog is not None:
        publish_layers(layout, catalog, settings)
    return enforce(layer_report(layout.bronze(), games, moves, layout.features(), settings))


def publish_layers(layout: Layout, prefix: str = "", settings: Settings = Settings()) -> None:
    """Layers and dashboard rows as views ``<prefix>silver.games`` and so on; they show the state of this run."""
    spark = layout.spark
    create_namespaces(spark, prefix)
    publish(spark, f"`{prefix}silver`.games", layout.games)
    publish(spark, f"`{prefix}silver`.moves", layout.moves)
    publish(spark, f"`{prefix}gold`.game_features", layout.gold)
    files = f"parquet.`{layout.path('bronze')}` WITH ('mergeSchema' = 'true')"
    create_view(spark, f"`{prefix}bronze`.snapshots", f"SELECT * FROM {files}")
    dashboard = VersionedTable(spark, layout.path("dashboard_games"))
    dashboard.write(dashboard_games(spark.table(f"`{prefix}silver`.games").drop("pgn"), settings))
    publish(spark, f"`{prefix}gold`.dashboard_games", dashboard)


def settings_of(args: argparse.Namespace) -> Settings:
    """Settings with whatever the command line says otherwise."""
    chosen = {k: v for k, v in vars(args).items() if k in Settings.__dataclass_fields__ and v is not None}
    return Settings(**chosen | ({"openings": tuple(chosen["openings"])} if "openings" in chosen else {}))


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--landing", required=True, help="folder of landed snapshots")
    parser.add_argument("--landed-as", choices=["documents", "rows"], default="documents")
    parser.add_argument("--root", required=True, help="folder of all tables, on shared storage")
    parser.add_argument("--accounts", required=True, help="Parquet of account, person_id, account_code")
    parser.add_argument("--friends", required=True, help="Parquet of person_id, opponent")
    parser.add_argument("--catalog", help="publish the layers as views, schema names with this prefix")
    parser.add_argument("--zone", help="time zone of local hours and weekdays")
    parser.add_argument("--rules", help="rules of the population")
    parser.add_argument("--time-class", help="time class of the population")
    parser.add_argument("--openings", nargs="+", help="openings with a column of their own")
    parser.add_argument("--min-games", type=int, help="fail below so many games")
    parser.add_argument("--min-population", type=int, help="fail below so many games of the population")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("hindsight").getOrCreate()
    accounts, friends = spark.read.parquet(args.accounts), spark.read.parquet(args.friends)
    report = refresh(
        args.landing, Layout(spark, args.root), accounts, friends, settings_of(args), args.landed_as, args.catalog
    )
    for name, _, detail in report:
        print(f"[PASS] {name}: {detail}")


if __name__ == "__main__":
    main()
