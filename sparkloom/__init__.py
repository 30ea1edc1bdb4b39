"""Code-base and corpus analytics as Spark DataFrame transformations."""
