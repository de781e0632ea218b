"""Value-added apportionment of electronic tax documents on Spark."""
