"""reelhouse: a Spark-native viewership lakehouse.

Layers: ``sources`` (scans, fixtures, sinks) -> ``operators`` (silver, history,
dimensions, facts, mart, analyst queries, quality, features) -> ``plans``
(end-to-end pipeline and query registry) -> ``streaming`` (incremental forms).
Every operator takes and returns DataFrames and triggers no action unless its
docstring says so.
"""

from reelhouse.session import apply_defaults, build_session, checkpoint_root

__all__ = ["apply_defaults", "build_session", "checkpoint_root"]
