"""Where rows go: JSON messages, previews, table directories, relational tables."""
