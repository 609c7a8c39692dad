"""Matchloom: record linkage and entity resolution as Spark DataFrame plans."""
