"""eventlens: product-event analytics on Spark DataFrames.

From raw event tables: a conformed, de-duplicated event table, daily and
monthly activity, inactivity sessions and conversion funnels, plus full and
incremental runs and data-quality checks.  Every operator is a plain
DataFrame -> DataFrame function built from Spark built-ins.
"""

from eventlens.config import Config, CustomColumn, PivotProperty

__all__ = ["Config", "CustomColumn", "PivotProperty"]
__version__ = "0.1.0"
