"""The layers: silver, gold, checks, reports, models, and one run of them all."""
