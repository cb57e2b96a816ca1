"""talentgrid: job matching and market analytics as Spark DataFrame jobs."""
