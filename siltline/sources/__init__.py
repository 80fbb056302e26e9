"""Reading and writing: files, layer tables, change topics, databases, table discovery."""
