"""Change capture and relational connectors, as DataFrames."""
