"""Named query plans over the driver's tables, each with its oracle SQL."""

from eventide.plans.registry import ORACLES, QUERIES  # noqa: F401
from eventide.plans import (  # noqa: F401  (modules register on import)
    q_basic,
    q_dist,
    q_functions,
    q_io,
    q_joins,
    q_state,
    q_time,
    q_keyed,
    q_topn,
    q_windows,
)


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
