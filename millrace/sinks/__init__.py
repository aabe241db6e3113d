"""Writers: DataFrames to files."""
