"""Model jobs on Spark ML (forests, least squares) and the isolation forest."""
