"""The warehouse as a whole and the queries served from it."""
