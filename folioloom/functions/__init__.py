"""functions of the document library."""
