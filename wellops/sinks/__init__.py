"""Writers: landing files, datasets, streaming tables, catalog tables."""
