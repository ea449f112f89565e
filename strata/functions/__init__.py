"""Column-level helpers: flattening nested records, page arithmetic, declared schemas."""
