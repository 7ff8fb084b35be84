"""shelflife — lot-level stock analytics for perishable goods on Spark.

Every operator is a pure function ``f(tables, **params) -> DataFrame`` over a
mapping of the nine model tables (see :mod:`shelflife.schemas`).  Nothing is
collected to the driver; plans are left to Catalyst and AQE.
"""

from shelflife.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
