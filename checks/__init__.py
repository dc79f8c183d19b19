"""Checks of the feature engine on the driver's tables: bindings, queries and their SQL oracles."""
