"""Composed plans: fixture adapters, the query catalogue and the medallion refresh."""
