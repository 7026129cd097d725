"""Group-outcome risk analytics as Spark jobs."""
