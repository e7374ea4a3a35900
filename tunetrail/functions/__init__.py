"""tunetrail."""
