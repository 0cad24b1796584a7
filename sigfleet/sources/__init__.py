"""Sources: driver tables, catalogue files, raw payloads, result documents."""
