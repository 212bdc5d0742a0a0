"""tidemark: retail analytics as plain DataFrame -> DataFrame operators on Spark."""
