"""Text snapshots, their manifest and file inventory, and the Parquet tables they land in."""
