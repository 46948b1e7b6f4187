"""Daily product-demand analytics as Spark plans.

Every operator is a function from DataFrames to a DataFrame.  None of them runs
an action, except where a docstring says so; the caller decides when to write.
"""

from shelfcast.settings import LifecycleRule, Settings

__all__ = ["LifecycleRule", "Settings"]
