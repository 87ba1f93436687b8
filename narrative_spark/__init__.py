"""Spark jobs over large collections of ordered narrative text."""
