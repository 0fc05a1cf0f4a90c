"""Hand-made games and snapshot files."""

import json
import os


def pgn(moves, clocks, date="2024.03.10", time="06:59:59", eco="A00"):
    head = f'[UTCDate "{date}"]\n[UTCTime "{time}"]\n' if date else ""
    head += f'[ECO "{eco}"]\n' if eco else ""
    body = []
    for i, san in enumerate(moves):
        clock = f"[%clk {clocks[i]}]" if i < len(clocks) else ""
        body.append(f"{i // 2 + 1}{'.' if i % 2 == 0 else '...'} {san} {{{clock}}}")
    return head + "\n" + " ".join(body)


def game(uuid="g1", white=("Acct_A", 1500, "win"), black=("rival", 1400, "resigned"), **other):
    out = {
        "uuid": uuid,
        "url": f"u/{uuid}",
        "end_time": 1710054600,
        "rated": True,
        "time_class": "rapid",
        "time_control": "600",
        "rules": "chess",
        "eco": "openings/x",
        "pgn": pgn(["e4", "c5"], ["0:09:58.1", "0:09:57"]),
        "white": dict(zip(("username", "rating", "result"), white)),
        "black": dict(zip(("username", "rating", "result"), black)),
    }
    return out | other


def write_snapshot(root, account, year, month, stamp, games):
    folder = f"{root}/username={account}/year={year}/month={month}"
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/games_{stamp}.json"
    with open(path, "w") as file:
        json.dump({"games": games}, file, indent=1)
    return path


def bronze(spark, rows):
    """rows: (account, games, modified second)."""
    from pyspark.sql import functions as F

    from hindsight.schemas import SNAPSHOT

    made = spark.createDataFrame(
        [(json.dumps({"games": g}), f"/s/username={a}/year=2024/month=03/games_{m}.json", m) for a, g, m in rows],
        "doc string, _source_file string, m long",
    )
    return made.select(
        F.from_json("doc", SNAPSHOT)["games"].alias("games"),
        "_source_file",
        F.timestamp_seconds("m").alias("_file_modified_at"),
        F.timestamp_seconds("m").alias("_ingested_at"),
    )


def dimensions(spark):
    accounts = spark.createDataFrame(
        [("acct_a", "p1", 0), ("acct_b", "p1", 1)], "account string, person_id string, account_code int"
    )
    friends = spark.createDataFrame([("p1", "Friend_1")], "person_id string, opponent string")
    return accounts, friends
