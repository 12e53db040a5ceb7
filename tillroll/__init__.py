"""tillroll: retail invoice-line analytics as plain Spark DataFrame programs."""
