"""Raw extracts: specs, header gate, batch load into bronze, lineage, audit."""
