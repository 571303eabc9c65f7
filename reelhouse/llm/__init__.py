"""Operators of a training-data pipeline; see README.  Nothing outside imports this
package but ``__spark_entry__.py`` (guarded) and ``corpus_pipeline.py``."""
