"""Tallyhouse: retail file ingest, staging, marts, quality rules and reports on Spark."""
