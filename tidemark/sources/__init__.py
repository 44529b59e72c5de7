"""Record sources and sinks: raw JSON, compacted Parquet, stats texts, wide tables, CSV export."""
