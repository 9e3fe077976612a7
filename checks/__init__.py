from checks import (  # noqa: F401
    basics,
    causal,
    modelling,
    panels,
    reports,
    sampling,
    scores,
    streams,
)
from checks.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
