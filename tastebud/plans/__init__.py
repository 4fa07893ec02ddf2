"""Composed query plans over the driver's tables, registered with SQL oracles."""
