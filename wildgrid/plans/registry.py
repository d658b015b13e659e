"""Every query of the reference's operators by name, with its SQL."""

from __future__ import annotations

from . import core, jobs, joins, matrices, reports

MODULES = (core, joins, reports, matrices, jobs)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.Q.functions.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in m.Q.sql.items()}
