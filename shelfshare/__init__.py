"""Stock allocation shares from sales and stock tables, as operators from DataFrames to a DataFrame."""
