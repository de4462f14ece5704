"""millrace: analytics and data-preparation jobs written on the PySpark DataFrame API."""
