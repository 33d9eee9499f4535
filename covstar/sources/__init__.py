"""Sources: raw feed readers, the events adapter, table readers."""
