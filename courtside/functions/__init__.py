from courtside.functions.bands import (adjusted_location, bool_flag, conference_of,
                                      game_impact, is_active, outcome_band,
                                      performance_vs_expectation, win_flag)
from courtside.functions.dates import (days_between, season_end_date, season_of_date,
                                      season_start_date, years_before)

__all__ = [
    "adjusted_location", "bool_flag", "conference_of", "days_between", "game_impact",
    "is_active", "outcome_band", "performance_vs_expectation", "season_end_date",
    "season_of_date", "season_start_date", "win_flag", "years_before",
]
