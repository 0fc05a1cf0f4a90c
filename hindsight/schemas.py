"""Declared schemas and column contracts of the three layers."""

from __future__ import annotations

# Field names of the source documents.
PLAYER = "struct<username: string, rating: bigint, result: string>"
GAME = (
    "struct<uuid: string, url: string, end_time: bigint, rated: boolean, time_class: string, "
    "time_control: string, rules: string, eco: string, pgn: string, "
    f"white: {PLAYER}, black: {PLAYER}>"
)
SNAPSHOT = f"games array<{GAME}>"
BRONZE = f"{SNAPSHOT}, _source_file string, _file_modified_at timestamp, _ingested_at timestamp, _variant variant, _raw string"

# Columns of silver games that a field of the document becomes as it is.
GAME_FIELDS = {
    "url": "url", "rated": "rated", "time_class": "time_class", "rules": "rules", "time_control": "time_control",
    "eco_url": "eco", "pgn": "pgn",
}

# Column contracts with types, checked before anything is built on a table.
GAMES_CONTRACT = {
    "game_uuid": "string",
    "account": "string",
    "url": "string",
    "rated": "boolean",
    "time_class": "string",
    "rules": "string",
    "time_control": "string",
    "base_seconds": "int",
    "increment_seconds": "int",
    "end_ts": "timestamp",
    "start_ts": "timestamp",
    "color": "string",
    "my_rating": "int",
    "opp_rating": "int",
    "opp_username": "string",
    "result": "string",
    "termination": "string",
    "eco_code": "string",
    "is_friend": "boolean",
    "is_self_play": "boolean",
}
MOVES_CONTRACT = {
    "game_uuid": "string",
    "account": "string",
    "ply": "int",
    "move_number": "int",
    "side": "string",
    "san": "string",
    "clock_seconds": "double",
    "is_my_move": "boolean",
}

GAME_KEY = ["game_uuid", "account"]
MOVE_KEY = ["game_uuid", "account", "ply"]
