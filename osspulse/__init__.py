"""Project-health analytics over open-source activity, written as Spark DataFrame plans."""
