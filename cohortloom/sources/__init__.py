"""Readers, writers and the keyed store, all on plain files Spark can read."""
