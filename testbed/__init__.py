"""Binding of the library to the generated test tables, and the SQL its results are checked against."""
