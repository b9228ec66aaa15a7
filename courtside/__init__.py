"""courtside: team game-result analytics on Spark DataFrames.

Raw game pages and CSV snapshots are staged into typed game and team
tables, a team dimension and a one-row-per-team-per-game fact; reports,
declared metrics and data-quality checks run over them as DataFrame
operators (see README.md).
"""

__version__ = "0.1.0"
