"""Writers: topics, tables, CSV and the places they keep their state."""
