"""Column-lineage analytics as Spark jobs: every function takes and returns DataFrames."""
