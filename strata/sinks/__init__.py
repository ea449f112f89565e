"""Sinks: bronze JSON, partitioned tables, single-object publish, stamped append (files),
JDBC replace/append, console preview."""
