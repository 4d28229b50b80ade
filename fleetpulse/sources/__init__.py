"""Data sources: raw matrices, Parquet tables and the stand-in fleets."""
