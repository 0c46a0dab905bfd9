"""Column helpers built from Catalyst expressions; none of them is a UDF."""
