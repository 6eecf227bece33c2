"""Names and constants a deployment may change; every operator takes them as arguments or from here."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    focal_team: str = "FOCUS"
    league: str = "Premier League"
    default_season: str = "2425"
    site_base: str = "https://site.example.com"
    portrait_pattern: str = "https://img.example.com/portrait/header/{id}.jpg"
    min_players_per_season: int = 20
    fresh_days: int = 10


DEFAULTS = Settings()
