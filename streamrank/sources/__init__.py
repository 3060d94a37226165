"""Reading topics and their file twins."""
