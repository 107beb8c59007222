"""DuckDB SQL that states, independently, what each registered query must return."""

from oracle import aggregates, business, cleaning, joins, models, quality, scalars, stages  # noqa: F401
from oracle.base import SQL

__all__ = ["SQL"]
