"""Reading and writing: files, tables, and the transaction view of an event table."""
