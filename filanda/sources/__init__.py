"""Sources: files and office documents as tables."""
