"""Landing zone and curated files."""
