"""The file-to-gold run driven by Structured Streaming."""
