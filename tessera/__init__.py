"""A Spark-first engine for curating large sets of generated samples."""
