"""Readers and writers: strict JSON lines, documents, file inventories, fixed registries."""
