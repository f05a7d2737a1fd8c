"""E-commerce analytics as Spark jobs; see README.md."""
