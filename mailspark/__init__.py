"""Labelled-text analytics and spam filtering on Spark DataFrames."""
