"""Writers: everything that changes a table or sends a message."""
