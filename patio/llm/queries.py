"""Registered queries of the operators, each with its SQL where SQL can say it."""

from patio.llm.plans import filters, learned, pairs, repairs, sizes

QUERIES = filters.QUERIES | sizes.QUERIES | learned.QUERIES | pairs.QUERIES | repairs.QUERIES
ORACLES = filters.ORACLES | sizes.ORACLES | learned.ORACLES | pairs.ORACLES | repairs.ORACLES
