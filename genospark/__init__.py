"""genospark: RNA-seq tables and training-data preparation as Spark jobs."""
