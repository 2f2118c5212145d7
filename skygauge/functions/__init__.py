"""Native column expressions; nothing here runs Python per row."""
