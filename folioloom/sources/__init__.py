"""sources of the document library."""
