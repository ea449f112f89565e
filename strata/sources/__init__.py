"""Sources: the paged JSON API source (S1), file scans (S3), local data (S2), ranges."""
