"""Composite jobs: ingest, subsets, clustering, reports and chart tables."""
