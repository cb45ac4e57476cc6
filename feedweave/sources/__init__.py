"""Reading and writing of delimited text, tables, lookups, cohort files, records."""
