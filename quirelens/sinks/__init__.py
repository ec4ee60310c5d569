"""Writers of packed files, count tables, page documents and update commands."""
