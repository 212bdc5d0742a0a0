"""CSV extracts in, parquet tables out."""
