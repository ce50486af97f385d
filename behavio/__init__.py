"""behavio: behaviour-log analytics on Spark DataFrames.

Every public operator takes DataFrames and column names and returns a
DataFrame; no operator collects data to the driver.  See README.md.
"""

__all__ = ["session", "operators", "sources", "functions", "plans", "streaming"]
