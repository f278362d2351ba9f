"""Reading and writing: JSON documents, CSV tables, Parquet tables."""
