"""Writers for tables, files and topics."""
