"""What one deployment may set: vocabularies, zone, population, floors."""

from __future__ import annotations

from dataclasses import dataclass, field

DAY = 86_400
WEEK = 7 * DAY

# Result codes of a drawn game.
DRAW_CODES = ("agreed", "repetition", "stalemate", "insufficient", "50move", "timevsinsufficient")
# The opening codes that get a column of their own.
ECO_CODES = ("A00", "A40", "A45", "B10", "B12", "B13", "D00", "D02", "D10")
# Weekday names in column order.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
# The three outcomes and their target codes.
OUTCOMES = {"won": 0, "draw": 1, "lost": 2}

# The 48 feature names, in table order.
FEATURES_48 = (
    "Account", "IsMonday", "IsTuesday", "IsWednesday", "IsThursday", "IsFriday", "IsSaturday", "IsSunday",
    "TimeOfDay", "GameOfDay", "GameOfWeek", "TimeControl", "EloDifference", "Color", "ICastledFirst",
    "ICastledShort", "ICastledLong", "OppCastledShort", "OppCastledLong", "LastResultIsWin", "LastResultIsDraw",
    "LastResultIsLoss", "2ndLastResultIsWin", "2ndLastResultIsDraw", "2ndLastResultIsLoss", "MyNumMoves",
    "OppNumMoves", "MyTotalTime", "OppTotalTime", "MyAvgTPM", "OppAvgTPM", "TimeSinceLast", "DailyWinPerc",
    "DailyLossPerc", "DailyDrawPerc", "WeeklyWinPerc", "WeeklyLossPerc", "WeeklyDrawPerc", "ECO_A00", "ECO_A40",
    "ECO_A45", "ECO_B10", "ECO_B12", "ECO_B13", "ECO_D00", "ECO_D02", "ECO_D10", "ECO_Other",
)

# The 28 features known before an activity starts.
MODEL_FEATURES = (
    "GameOfDay", "GameOfWeek", "TimeOfDay", "TimeSinceLast", "IsMonday", "IsTuesday", "IsWednesday",
    "IsThursday", "IsFriday", "IsSaturday", "IsSunday", "DailyWinPerc", "DailyDrawPerc", "DailyLossPerc",
    "WeeklyWinPerc", "WeeklyDrawPerc", "WeeklyLossPerc", "Color", "ECO_A00", "ECO_A40", "ECO_A45", "ECO_B10",
    "ECO_B12", "ECO_B13", "ECO_D00", "ECO_D02", "ECO_D10", "ECO_Other",
)


@dataclass(frozen=True)
class Settings:
    """One deployment. Accounts and friends are tables, not settings."""

    zone: str = "America/New_York"
    rules: str = "chess"
    time_class: str = "rapid"
    draw_codes: tuple[str, ...] = DRAW_CODES
    openings: tuple[str, ...] = ECO_CODES
    frames: dict[str, int] = field(default_factory=lambda: {"Daily": DAY, "Weekly": WEEK})
    trailing_months: int = 2
    min_games: int = 0
    min_population: int = 0
