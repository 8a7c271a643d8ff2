"""sonora -- listening-history analytics as Spark DataFrame plans.

Layers:
  sonora.sources    -- landing formats (raw JSON lake, scrobble API pages,
                       watch-history export) and table sinks
  sonora.functions  -- Column expressions (text cleanup, play-time parsing,
                       mood estimation, vector maths)
  sonora.operators  -- DataFrame -> DataFrame operators (load, staging,
                       features, daily roll-up, fingerprint, similarity,
                       serving, quality checks)
  sonora.plans      -- named end-to-end queries over the test tables and
                       their SQL twins
  sonora.streaming  -- incremental loading with Structured Streaming
"""
from sonora.session import build_session, prepare

__all__ = ["build_session", "prepare"]
