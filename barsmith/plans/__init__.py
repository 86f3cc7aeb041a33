"""Composed jobs: the monthly ETL run and the query catalogue."""
