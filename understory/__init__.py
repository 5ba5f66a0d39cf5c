"""Forest-structure analytics over 3-D points, written for Spark DataFrames."""
