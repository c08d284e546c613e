"""Named query plans over the driver's tables (``queries``) and their DuckDB
oracles (``oracle_sql``)."""

from likeness.plans.queries import QUERIES, PARAMS
from likeness.plans.oracles import ORACLES

__all__ = ["QUERIES", "PARAMS", "ORACLES"]
