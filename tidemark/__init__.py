"""Change-data-capture tables on Spark: deduplicated history and SCD type 2.

Everything is a DataFrame transformation; the same functions run on a static
DataFrame and inside a Structured Streaming micro-batch.
"""

from tidemark.config import CdcFeed, FlatFeed, MergeRules

__all__ = ["CdcFeed", "FlatFeed", "MergeRules"]
