"""Flows built from the operators: the medallion flow (F1), the API crawl job, run
reports, lineage cuts, and the registered queries."""
