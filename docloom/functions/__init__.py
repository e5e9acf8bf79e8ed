"""Column expressions over Markdown text, and the line table."""
