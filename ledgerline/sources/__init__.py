"""Sources and sinks: CSV feeds, the feed derived from the driver tables,
and the Parquet layer writers."""
