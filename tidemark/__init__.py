"""Tidemark: prediction-market analytics and corpus preparation as Spark plans."""
