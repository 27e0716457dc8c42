"""pricelens: Spark-native event-price analytics.

Every operator is a function ``DataFrame(s) + column names -> DataFrame`` built
from the DataFrame / Structured Streaming API, so Catalyst plans, prunes and
pushes down the whole chain.  Run times are parameters, never ``now()``.
"""

from pricelens.session import build_session, ensure_utc, scratch_dir

__all__ = ["build_session", "ensure_utc", "scratch_dir"]
