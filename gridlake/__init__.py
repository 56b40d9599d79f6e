"""gridlake: metered-usage analytics written with the Spark DataFrame, SQL and
Structured Streaming APIs.

Every public function takes DataFrames (plus parameters) and returns a
DataFrame. Most are lazy; the global-ordering helpers (dense keys, exact
percentiles) run one eager job that checkpoints an intermediate into the
shared checkpoint folder. No data rows are collected to the driver, only
bounded metadata (two window dates, a batch's touched dates, row counts).
Planning and execution are left to Catalyst / AQE.
"""

__all__ = ["fixed", "schemas", "session"]
