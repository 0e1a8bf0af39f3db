"""Incremental processing of an advancing block height."""
