"""Customer and finance reconciliation as Spark jobs."""
