"""The same results in DuckDB SQL, written apart from the library."""

from oracles.views import with_views
from oracles.statements import STATEMENTS

ORACLES = {name: with_views(sql) for name, sql in STATEMENTS.items()}
