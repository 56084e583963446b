"""Column expressions: no function here touches a DataFrame, a session or a file."""
