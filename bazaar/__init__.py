"""Bazaar: a medallion commerce lake written as Spark DataFrame operations."""
