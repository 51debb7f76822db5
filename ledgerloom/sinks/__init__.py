"""Writers: delimited text, quarantine, append, reload and upsert."""
