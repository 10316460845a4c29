"""Reading and writing: files, tables, named-query results."""
