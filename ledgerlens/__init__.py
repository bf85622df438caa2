"""ledgerlens — retail-order analytics and data-quality operators on Spark.

Every operator is a pure function ``op(tables, **params) -> DataFrame`` over
the five logical tables held by :class:`ledgerlens.sources.adapter.Tables`.
The heavy work stays inside Spark plans: no fact data is collected to the
driver and no row-at-a-time Python runs in a hot path.
"""

from ledgerlens.session import get_spark, ensure_checkpoint_dir  # noqa: F401
from ledgerlens.sources.adapter import Tables, load_tables  # noqa: F401
