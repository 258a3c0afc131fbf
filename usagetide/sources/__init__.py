"""Typed readers, sinks and the adapter from event tables to source tables."""
