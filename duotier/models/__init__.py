"""Model tier: pyspark.ml feature pipeline, candidates, registry tables, scoring."""
