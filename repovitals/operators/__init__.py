"""Jobs that turn one layer into the next. Each takes and returns DataFrames."""
