"""Writers: JSON lines, per-answer JSON, checksums, package directories and archives."""
