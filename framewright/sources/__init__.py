"""File listings, decoders and archive writers."""
