"""Sources and sinks: file listings, tables, GeoTIFF, GeoJSON, shapefiles, GeoPackage, archives."""
