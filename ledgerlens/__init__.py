"""ledgerlens: fundamental equity screening as Spark DataFrame plans.

Landed company reports and price records become typed, run-date
partitioned Parquet tables; ratios are computed per company and fiscal
period, scored against value-investing thresholds and published as an
idempotently reloaded screening fact with its dimensions.
"""

__all__ = ["config", "schemas", "session"]
