"""Sources: the driver tables, domain fixtures derived from them, text and region scans."""
