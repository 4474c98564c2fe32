"""Registered queries by family."""

from patio.plans import (cleaning, columns, dashboard, explained, exports, modelling, rankings,  # noqa: F401
                         segmentation, statistics, summaries)
from patio.plans.registry import ORACLES, QUERIES  # noqa: F401
