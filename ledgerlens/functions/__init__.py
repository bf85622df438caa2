"""Column-level helpers shared by the operators (all native Spark expressions)."""

from ledgerlens.functions.core import *  # noqa: F401,F403
