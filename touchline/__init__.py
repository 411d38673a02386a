"""touchline: marketing attribution on Spark DataFrames.

Every model is a pure ``DataFrame -> DataFrame`` function built from
built-in Spark expressions, so Catalyst can prune, push down and plan
the whole chain from the raw event scan to the marts.
"""

from touchline.config import AttributionConfig

__all__ = ["AttributionConfig"]
