"""Reading, conforming, materialising and exporting tables."""
