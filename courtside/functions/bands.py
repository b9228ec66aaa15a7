"""Labelling columns for games and teams (searched CASE chains as Column functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtside.functions.util import col_of

# ---- fixed values: labels and thresholds that must equal the reference ----
# Point differential: the first band whose lower bound the differential
# exceeds; exactly 0 is a tie; anything else (or unknown) the last label.
WIN_BANDS = ((20, "Blowout Win"), (10, "Comfortable Win"), (0, "Close Win"))
TIE_LABEL = "Tie"
LOSS_BANDS = ((-10, "Close Loss"), (-20, "Comfortable Loss"))
WORST_LABEL = "Blowout Loss"
# Win probability vs result: a win below the bound, or a loss above it.
UPSET_WIN_BANDS = ((0.3, "Major Upset"), (0.45, "Minor Upset"))
UPSET_LOSS_BANDS = ((0.7, "Major Upset Loss"), (0.55, "Minor Upset Loss"))
EXPECTED_LABEL = "Expected Result"
# Absolute rating change above the bound.
IMPACT_BANDS = ((30, "High Impact"), (20, "Medium Impact"))
LOW_IMPACT_LABEL = "Low Impact"
UPSET_WIN_LABELS = tuple(l for _, l in UPSET_WIN_BANDS)
# Default conference membership by team code.
EASTERN_CODES = ("BOS", "BKN", "NYK", "PHI", "TOR", "CHI", "CLE", "DET", "IND", "MIL",
                 "ATL", "CHA", "MIA", "ORL", "WAS")
WESTERN_CODES = ("DEN", "MIN", "OKC", "POR", "UTA", "GSW", "LAC", "LAL", "PHX", "SAC",
                 "DAL", "HOU", "MEM", "NOP", "SAS")
CONFERENCES = ("Eastern", "Western", "Historical")
# ---- end of fixed values ----------------------------------------------------


def win_flag(score_for, score_against) -> Column:
    """1 when strictly ahead, else 0 (a NULL score gives 0, not NULL)."""
    return F.when(col_of(score_for) > col_of(score_against), 1).otherwise(0)


def bool_flag(c) -> Column:
    """TRUE -> 1, FALSE and NULL -> 0."""
    return F.when(col_of(c), 1).otherwise(0)


def first_match(rules, default) -> Column:
    """The label of the first (condition, label) rule that holds, else ``default``.

    A NULL condition does not hold, so unknown inputs fall through to the default.
    """
    out = None
    for cond, label in rules:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def outcome_band(score_diff) -> Column:
    d = col_of(score_diff)
    rules = [(d > bound, label) for bound, label in WIN_BANDS]
    rules.append((d == 0, TIE_LABEL))
    rules += [(d > bound, label) for bound, label in LOSS_BANDS]
    return first_match(rules, WORST_LABEL)


def performance_vs_expectation(win, win_probability) -> Column:
    w, p = col_of(win), col_of(win_probability)
    rules = [((w == 1) & (p < bound), label) for bound, label in UPSET_WIN_BANDS]
    rules += [((w == 0) & (p > bound), label) for bound, label in UPSET_LOSS_BANDS]
    return first_match(rules, EXPECTED_LABEL)


def game_impact(rating_change) -> Column:
    a = F.abs(col_of(rating_change))
    return first_match([(a > bound, label) for bound, label in IMPACT_BANDS], LOW_IMPACT_LABEL)


def adjusted_location(neutral, location) -> Column:
    return F.when(col_of(neutral) == 1, F.lit("NEUTRAL")).otherwise(col_of(location))


def conference_of(team_id, eastern=EASTERN_CODES, western=WESTERN_CODES) -> Column:
    """Conference from membership lists; anything else is 'Historical'.

    A column expression rather than a self-join, so one team id can never
    produce more than one conference row.
    """
    t = col_of(team_id)
    east, west, other = CONFERENCES
    return (F.when(t.isin(list(eastern)), east).when(t.isin(list(western)), west)
            .otherwise(other))


def is_active(last_game_date, as_of, years: int = 2) -> Column:
    """Last game no earlier than ``as_of`` minus ``years``; unknown counts as inactive."""
    from courtside.functions.dates import years_before
    return F.coalesce(col_of(last_game_date) >= years_before(as_of, years), F.lit(False))
