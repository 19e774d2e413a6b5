"""Entity-resolution operators as DataFrame compositions."""
