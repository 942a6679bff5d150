"""Social-content analytics as Spark DataFrame transformations."""
