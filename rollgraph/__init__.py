"""Registry linkage and entity graphs as lazy Spark plans."""
