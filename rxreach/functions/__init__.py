"""Column helpers and global order statistics."""
