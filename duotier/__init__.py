"""duotier: two-tier item classification (classifier + answerer) as Spark DataFrame jobs."""
