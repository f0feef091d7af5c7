"""Game-centre log analytics as plain Spark jobs: batch reports and running stream totals."""
