"""Candidate generation for recommenders, written as Spark DataFrame jobs."""
