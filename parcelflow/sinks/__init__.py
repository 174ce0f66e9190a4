"""Archives, topics, tables and files."""
