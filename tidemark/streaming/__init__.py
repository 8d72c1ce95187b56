"""The main operators on unbounded streams, and lookups in their state."""
