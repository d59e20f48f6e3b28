"""Passenger-carrier analytics on Spark DataFrames."""
