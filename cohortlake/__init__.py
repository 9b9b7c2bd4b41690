"""cohortlake: pooling of human-biomonitoring evidence as Spark DataFrame operators."""
