"""Relational operators over frames, pairs, shards and tensors."""
