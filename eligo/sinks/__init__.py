"""Writers: raw partitions, table creation, batch publish, compaction."""
