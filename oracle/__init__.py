"""SQL checks of the named queries, self-contained over the star-schema tables."""

from oracle.base import compose
from oracle.checks import CHECKS

ORACLES = {name: compose(body) for name, body in CHECKS.items()}
