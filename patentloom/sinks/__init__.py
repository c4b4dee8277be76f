"""Writers for report files and keyed tables."""
