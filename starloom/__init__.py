"""starloom: survey-imaging analytics as Spark DataFrame programs."""
