"""Text and character-record analytics expressed as Spark DataFrame jobs."""
