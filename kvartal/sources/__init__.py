"""Reading, staging and publishing tables."""
