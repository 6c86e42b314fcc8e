"""Writers: messages, versioned tables, served tables, coordinate files."""
