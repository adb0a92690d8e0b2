"""Writers: tables and run folders."""
