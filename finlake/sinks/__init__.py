"""Writers: keyed upsert and table maintenance."""
