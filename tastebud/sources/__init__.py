"""Readers, sinks and the driver-table mappings."""
