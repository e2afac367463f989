"""Raw text snapshots to audited analytical marts, as Spark jobs."""
