"""delaystar: a Spark-native warehouse for public-transport departure delays.

Landed observations become a deduplicated history, date/route/stop dimensions
and a delay fact; a shared reporting view feeds KPI, ranking, trend, category
and time-period reports; audits, quality checks, incremental merges and a
Structured Streaming collector complete the pipeline.  Every operator is a
``DataFrame -> DataFrame`` function built from native column expressions.
"""

__all__ = ["settings"]
