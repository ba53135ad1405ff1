"""Import every query module so that its queries register, then expose the tables."""

from glossa.plans import queries  # noqa: F401  (registers on import)
from glossa.plans import queries_lm  # noqa: F401
from glossa.plans import queries_sweep  # noqa: F401
from glossa.plans import queries_tagger  # noqa: F401
from glossa.plans.queries import ORACLE, REGISTRY

__all__ = ["ORACLE", "REGISTRY"]
