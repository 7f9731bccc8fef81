"""Input schemas, file readers and writers, stage storage."""
