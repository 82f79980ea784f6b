"""Reading and writing: text lists, JSON lines, JDBC, versioned tables, page stores."""
