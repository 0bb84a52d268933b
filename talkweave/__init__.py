"""Chat analytics on PySpark: raw chatbot turns in, one analysable row per chat out."""
