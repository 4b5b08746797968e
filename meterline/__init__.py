"""Spark-native metered-usage analytics: rating, rollups, ledgers, reconciliation and inventories."""
