"""plans of the document library."""
