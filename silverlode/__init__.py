"""silverlode: a sales warehouse built from raw extracts with plain Spark jobs.

Layers: ``sources`` (files in, bronze out), ``functions`` (Column helpers), ``operators`` (reusable
DataFrame jobs), ``plans`` (the silver, gold and mart definitions) and ``streaming`` (once-per-file
ingest).
"""

from silverlode.config import Settings
from silverlode.session import get_session

__all__ = ["Settings", "get_session"]
