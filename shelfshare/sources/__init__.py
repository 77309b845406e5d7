"""Reading and writing: typed scans of the logical tables, mapping files, tables and exports."""
