"""Rooftop solar analytics and corpus preparation on Spark DataFrames."""
