"""The medallion flow as an incremental Structured Streaming job."""
