"""cartwheel — commerce analytics (load, stage, model, report, check) on Spark.

Layout:
  sources/    driver-table adapter, table registry, load strategies, landing scans
  functions/  Column-returning helpers (keys, money, ratios, dates)
  operators/  reusable DataFrame operators (sessionize, rollups, windows,
              history/SCD2, checks, writers, documented patterns)
  plans/      the models (staging → intermediate → core → reporting), the daily
              run, and the query registry used by ``__spark_entry__``
  streaming/  Structured Streaming form of sessionization
"""

from cartwheel.params import Params  # noqa: F401
from cartwheel.session import build_session, ensure_session_defaults  # noqa: F401
