"""Spark jobs over the test tables; see README.md for what is and is not here."""
