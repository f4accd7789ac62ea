"""Writers: date-partitioned tables, feed-compatible text files, search documents, run log."""
