"""Layered-lakehouse data jobs as plain functions over Spark DataFrames.

functions/   column expressions: text and number cleaning, dates, fingerprints
operators/   DataFrame -> DataFrame jobs: dedup, history, keys, lookups, checks
sources/     file batches, lineage columns, table reads and writes
streaming/   incremental file and table ingest, change-feed apply
plans/       whole layered runs put together from the parts above
"""
